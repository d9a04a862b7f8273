"""Queries read all rows of their tables."""

from datetime import datetime

from evidentia import queries


def test_union_of_groups_reads_all_events(spark, tmp_path):
    rows = [(i, i % 7, datetime(2024, 1, 1), f"t{i % 4}", 0.0, "{}") for i in range(28)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = [tuple(r) for r in queries.union_of_groups(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted({(r[1], r[3]) for r in rows})


def test_manifest_chunks_has_no_largest_id(spark, tmp_path):
    spark.createDataFrame([(i, f"u{i}", "") for i in (1, 10_000_000, 10_000_001, 1 << 40)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert queries.manifest_chunks(spark, str(tmp_path)).count() == 4
