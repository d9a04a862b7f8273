"""Archives: ids of any text, and comments that hold signatures."""

import io
import zipfile
from collections import Counter

from evidentia.llm import warc


def test_string_ids(spark):
    big = "é" * 700
    rows = [("null", "u", big), (None, "u", big), ("a\nb c", "u", big), ("id-x", None, "s"), ("", "u", None), ("zz%", "u", "t" * 2000), ("zz%", "u", "t" * 2000)]
    d = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(d).collect())
    assert got == Counter({("null", "response", None, 1400): 1, (None, "revisit", "null", 1400): 1, ("a\nb c", "revisit", "null", 1400): 1, ("id-x", "response", None, 1): 1, ("", "response", None, 0): 1, ("zz%", "response", None, 2000): 2})


def test_a_hot_payload_and_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_BITS", 16)
    d = spark.createDataFrame([(i, "u", "hot " * 300 if i % 3 == 0 else f"{i} " * 400) for i in range(300)], "page_id long, url string, html string")
    got = warc.round_trip(d).collect()
    assert Counter((r.record_type, r.refers_to) for r in got) == {("response", None): 201, ("revisit", 297): 99}
    assert {r.page_id for r in got} == set(range(300))


def test_signature_in_the_comment():
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("a", b"hello")
        z.comment = warc.EOCD + b"x" * 30 + warc.EOCD
    raw = f.getvalue()
    assert warc.ZipRanges(lambda o, n: raw[o : o + n], len(raw)).range("a") == b"hello"
