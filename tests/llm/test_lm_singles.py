"""op8 keeps pairs that training saw once."""

from evidentia.llm import queries
from test_operators import scores


def test_pairs_seen_once_count(spark, tmp_path):
    texts = {i: f"alpha{i} beta{i} gamma delta{i % 3}" for i in range(40)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {r[0]: r for r in scores(texts.items())}
    for r in queries.op8_lm(spark, str(tmp_path)).collect():
        assert abs(r.score - want[r.doc_id][5]) < 0.0003 * want[r.doc_id][1]
