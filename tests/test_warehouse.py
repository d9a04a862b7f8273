"""Projection, archive, rebuild and crawl: fixed cases and invariants."""

import gzip
import json
import os
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from evidentia.functions import scalars as S
from evidentia.operators import equivalence as E
from evidentia.operators import projection as P
from evidentia.plans import materialize
from evidentia.schemas import CANONICAL, COLUMNS, ENVELOPE
from evidentia.sources import archive
from evidentia.sources.catalog import Catalog, inspect
from evidentia.sources.control import ControlStore
from evidentia.sources.store import HadoopStore, LocalStore


def envelopes(spark, envs):
    rows = [json.dumps(e | {"payload": archive.payload_text(e)}) for e in envs]
    return spark.createDataFrame([(r,) for r in rows], "v string").select(F.from_json("v", ENVELOPE).alias("e")).select("e.*")


@pytest.fixture(scope="module")
def pages():
    return archive.fixture()


@pytest.fixture(scope="module")
def state(spark, pages):
    return sorted(map(tuple, P.project(envelopes(spark, pages)).collect()))


def test_fixture_projects_to_85(state):
    assert len(state) == 85
    by = {r[COLUMNS.index("content")] for r in state}
    assert "message 19 seen on page 0" in by and "message 20 seen on page 1" in by


def test_order_and_duplicates_change_nothing(spark, pages, state):
    r = random.Random(42)
    for _ in range(2):
        mixed = pages * 2
        r.shuffle(mixed)
        assert sorted(map(tuple, P.project(envelopes(spark, mixed)).collect())) == state
    parts = [P.project(envelopes(spark, pages[i::2])) for i in range(2)]
    assert sorted(map(tuple, P.reduce(*parts).collect())) == state


def with_page(env, *messages):
    return env | {"payload": list(messages)}


MESSAGE = {"id": "175928847299117063", "channel_id": "2", "author": {"id": "3", "username": "u", "bot": False}, "content": "c", "timestamp": "2026-01-01T00:00:00Z"}


def test_refused(spark, pages):
    for change in ({"envelope_version": "v2"}, {"observation_id": "123e4567-e89b-12d3-a456-426614174000"}, {"source_kind": "gateway"}, {"observed_at": "2026-01-01T00:00:00"}):
        with pytest.raises(Exception):  # noqa: B017
            P.project(envelopes(spark, [pages[0] | change])).collect()
    other = pages[0] | {"payload": pages[1]["payload"]}
    with pytest.raises(Exception, match="two payloads"):
        P.once(envelopes(spark, [pages[0], other])).count()


@pytest.mark.parametrize("change", [{"id": "x"}, {"id": ""}, {"timestamp": "2026-01-01 00:00:00"}, {"timestamp": None}, {"edited_timestamp": "soon"}])
def test_refusals_hold_whatever_is_read(spark, pages, change):
    e = envelopes(spark, [with_page(pages[0], MESSAGE, MESSAGE | change)])
    for read in (lambda: P.project(e).count(), lambda: P.history(e).select("content").collect(), lambda: P.snapshots(e).select(F.lit(1)).collect()):
        with pytest.raises(Exception):  # noqa: B017
            read()
    with pytest.raises(Exception, match="not an HTTP"):
        P.snapshots(envelopes(spark, [pages[0] | {"source_kind": "gateway"}])).count()


def test_strict_contract(spark, pages):
    assert P.validated(envelopes(spark, pages), True).count() == 4
    p = pages[0]["provenance"]
    for change in ({"limit": 0}, {"http_status": 99}, {"capabilities": {}}, {"guild_id": "g"}, {"operation": None}, {"operation": ""}, {"run_id": "r"}, {"rate_limit": None}, {"rate_limit": p["rate_limit"] | {"limit": -1}}, {"request_started_at": "now"}, {"pagination": {"before": "x", "after": None}}):
        with pytest.raises(Exception, match="refused envelope"):
            P.validated(envelopes(spark, [pages[0] | {"provenance": p | change}]), True).count()


def test_scalars(spark):
    one = spark.range(1)
    assert one.select(S.snowflake_ms(F.lit("175928847299117063"))).first()[0] == 1462015105796
    assert one.select(S.snowflake_ms(F.lit("1e3"))).first()[0] is None
    assert [r[0] for r in spark.range(9).select(S.backoff_ms(F.col("id"))).collect()] == [2000, 4000, 8000, 16000, 32000, 64000, 128000, 256000, 300000]
    assert one.select(S.retry_after_ms(F.lit(0.75), F.lit(3.0)), S.retry_after_ms(F.lit(None).cast("double"), F.lit(3.0))).first() == (750, 3000)


RUN = "0199a1b2-0000-7000-8000-000000000001"


def test_archive(spark, pages, state, tmp_path):
    root = str(tmp_path / "a")
    assert [archive.put(root, e) for e in pages] == ["created"] * 4 and archive.put(root, pages[0]) == "idempotent_retry"
    with pytest.raises(ValueError, match="another observation"):
        archive.put(root, pages[0] | {"payload": []})
    with pytest.raises(ValueError, match="refused"):
        archive.put(root, pages[0] | {"envelope_version": "v2"})
    key = archive.key_of(pages[0])
    assert archive.get(root, key) == pages[0]
    raw = (tmp_path / "a" / key).read_bytes()
    assert archive.stored_metadata(raw) == archive.metadata(pages[0]) and archive.stored_metadata(gzip.compress(gzip.decompress(raw))) == archive.metadata(pages[0])
    for bad in (raw[:-9], b"x", gzip.compress(b"{}"), gzip.compress(b"[")):
        with pytest.raises(ValueError):
            archive.decode(bad)
    assert archive.listing(spark, root).count() == 4 and sorted(map(tuple, materialize.rebuild(spark, root).collect())) == state
    assert materialize.rebuild(spark, root, start=datetime(2026, 9, 21, tzinfo=UTC), end=datetime(2026, 9, 21, 0, 1, tzinfo=UTC)).count() == 25
    assert archive.delete(root, key) and not archive.delete(root, key) and archive.listing(spark, root).count() == 3
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "schema.json").write_text("{}")
    (tmp_path / "f" / "b.json").write_text(json.dumps(pages[1]))
    (tmp_path / "f" / "a.json").write_text(json.dumps(pages[0]))
    assert archive.load_fixtures(str(tmp_path / "f")) == pages[:2]
    (tmp_path / "f" / "c.json").write_text("{}")
    with pytest.raises(ValueError):
        archive.load_fixtures(str(tmp_path / "f"))


@pytest.mark.parametrize("make", [lambda spark, p: LocalStore(str(p)), lambda spark, p: HadoopStore(spark, f"file://{p}/h")])
def test_stores(spark, tmp_path, make):
    s = make(spark, tmp_path)
    assert s.put_if_absent("a/x.json", b"1") and not s.put_if_absent("a/x.json", b"2") and s.get("a/x.json") == b"1" and s.get("a/y.json") is None
    s.put("a/x.json", bytes(range(256)))
    s.put("b.json", b"")
    assert s.get("a/x.json") == bytes(range(256)) and [k for k, _ in s.list()] == ["a/x.json", "b.json"] and [k for k, _ in s.list("a")] == ["a/x.json"]
    assert s.delete("a") and s.get("a/x.json") is None and s.list("a") == []


def test_half_written_object_is_never_seen(pages, tmp_path, monkeypatch):
    def dies(*_):
        raise OSError("disk")

    root = str(tmp_path / "a")
    monkeypatch.setattr("os.link", dies)
    with pytest.raises(OSError):
        archive.put(root, pages[0])
    monkeypatch.undo()
    assert LocalStore(root).list() == [] and archive.put(root, pages[0]) == "created"


@pytest.mark.parametrize("point", ["after_candidates", "after_stage", "after_commit"])
def test_resumed_run(spark, pages, state, tmp_path, point):
    root, crashes = str(tmp_path / "a"), []
    for e in pages:
        archive.put(root, e)

    def fault(p):
        if p == point and not crashes:
            crashes.append(p)
            raise RuntimeError("crash")

    class Counted(materialize.SparkArchive):
        read = 0

        def envelopes(self, keys):
            Counted.read += 1
            return super().envelopes(keys)

    late = datetime.now(UTC) + timedelta(days=1)
    catalog, control, reader = Catalog(spark, str(tmp_path / "t")), ControlStore(str(tmp_path / "c")), Counted(spark, root)
    cfg = materialize.Config(RUN, chunk=2, batch=40, concurrency=2, fault=fault)
    with pytest.raises(RuntimeError):
        materialize.run(spark, control, catalog, reader, cfg, late)
    assert control.get(f"runs/{RUN}/status.json")["failure"] == "crash"
    began = control.get(f"runs/{RUN}/status.json")["started_at"]
    archive.put(root, pages[0] | {"observation_id": archive.uuid7(1, b"later")})  # not in the fixed manifest
    cfg.max_units, n = 1, 0
    while (got := materialize.run(spark, control, catalog, reader, cfg, late))["phase"] != "completed":
        n += 1
    assert n and got["started_at"] == began and got["failure"] == "" and got["row_count"] == 85 and got["commit_batch_count"] == 3
    assert Counted.read <= 2 + (point == "after_candidates") * 2
    assert len(catalog.referenced("message")) == 3 and sorted(map(tuple, catalog.scan("message").collect())) == state
    one = control.get(f"runs/{RUN}/extract/00000.json")
    assert one["object_keys"] == 2 and one["row_count"] == 45 and len(one["chunk_id"]) == len(one["digest"]) == 64
    assert E.digest(catalog.scan("message")) == E.digest(P.project(envelopes(spark, pages)))
    files = catalog.referenced("message")
    for f in files:
        ids = [r.message_id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)
    assert inspect(catalog.store, os.path.relpath(files[0], catalog.root)) == {"rows": 40, "codecs": ["ZSTD"]}
    assert catalog.commit("message", files) == catalog.commit("message", []) == "already_referenced"
    with pytest.raises(ValueError):
        catalog.commit("message", [files[0], "/new"])
    with pytest.raises(ValueError):
        catalog.add_files("message", files[:1])
    assert catalog.sql("message", "select message_id, content from message order by message_id limit 500").count() == 85
    assert materialize.run(spark, control, catalog, reader, cfg, late)["phase"] == "completed" and catalog.referenced("message") == files
    with pytest.raises(ValueError, match="run id"):
        materialize.run(spark, control, catalog, reader, materialize.Config("r1"))
    assert catalog.drop("message") and not catalog.exists("message")


def test_commits_of_two_writers(spark, tmp_path, monkeypatch):
    one, two = (Catalog(spark, str(tmp_path)) for _ in range(2))
    one.ensure_table("t")
    read = Catalog.state

    def late(self, name):
        got = read(self, name)
        if self is one and not two.referenced("t"):
            two.commit("t", ["/a"])
        return got

    monkeypatch.setattr(Catalog, "state", late)
    with pytest.raises(ValueError):
        one.commit("t", ["/a", "/b"])
    assert two.referenced("t") == ["/a"]
    monkeypatch.undo()
    for i in range(140):
        assert one.commit("t", [f"/{i}"]) == "committed"
    assert len(two.referenced("t")) == 141 and one.store.get("t/kept/last.json") == b'{"n": 128}' and len(one.snapshots("t")) == 142
    assert one.replace("t", ["/z"]) == "committed" and two.referenced("t") == ["/z"]


def test_equivalence_sees_each_field(spark, state):
    table = spark.createDataFrame([tuple(r) for r in state], CANONICAL)
    base, exact = E.digest_any(table).first(), E.digest(table)
    for c in E.FIELDS:
        kind = CANONICAL[c].dataType.simpleString()
        new = {"boolean": ~F.col(c), "timestamp": F.coalesce(F.col(c), F.col("created_at")) + F.expr("interval 1 microsecond")}.get(kind, F.concat(c, F.lit("x")))
        other = table.withColumn(c, F.when(F.col("message_id") == state[0][0], new).otherwise(F.col(c)))
        assert E.digest_any(other).first() != base and E.digest(other) != exact
        assert sorted(r.sign for r in E.diff(E.rows(table), E.rows(other)).collect()) == ["+", "-"]
        assert E.same_identities(table, other) == (c not in E.IDENTITY)
    assert E.diff(E.rows(table), E.rows(table.unionByName(table))).count() == 0


def test_quoting():
    assert E.quoted('a"b\\\n\t\x00\x7f é\u200b\U0001f600\u00a0') == '"a\\"b\\\\\\n\\t\\x00\\x7f é\\u200b\U0001f600\\u00a0"'


def test_parquet_field_ids(spark, state, tmp_path):
    import pyarrow.parquet as pq

    spark.createDataFrame([tuple(r) for r in state[:3]], CANONICAL).coalesce(1).write.option("compression", "zstd").parquet(str(tmp_path / "p"))
    f = next((tmp_path / "p").glob("*.parquet"))
    assert [int(x.metadata[b"PARQUET:field_id"]) for x in pq.read_schema(f)] == list(range(1, 17))
    assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD"


def test_chunks(spark):
    got = P.chunks(spark.range(5).select(F.format_string("k%02d", "id").alias("k")), "k", 2).orderBy("k").collect()
    assert [r.chunk for r in got] == [0, 0, 1, 1, 2]


def test_chunks_without_exchange_reuse(spark):
    rows = spark.range(30_000).select((F.col("id") * 7919 % 30_000).alias("k"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert P.chunks(rows, "k", 70).where("chunk <> k div 70").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
