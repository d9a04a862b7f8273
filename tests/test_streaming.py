"""Streams, erasure, relations and clients."""

import hashlib
import hmac
import json
import random
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from test_warehouse import envelopes

from evidentia.functions import scalars as S
from evidentia.operators import community, erasure
from evidentia.operators import projection as P
from evidentia.plans.crawl import Budget
from evidentia.sources import archive
from evidentia.sources.catalog import Catalog
from evidentia.sources.pages import PageClient, PagedSource
from evidentia.sources.remote_sql import RemoteSql, rows_of
from evidentia.streaming import incremental as I


@pytest.fixture(scope="module")
def pages():
    return archive.fixture()


def test_incremental_equals_rebuild(spark, pages, tmp_path):
    root, catalog = str(tmp_path / "a"), Catalog(spark, str(tmp_path / "t"))
    for e in pages[:2]:
        archive.put(root, e)
    add = I.append_winners(catalog, "message", "stream")

    def once():
        q = I.read_archive(spark, root, 1).writeStream.foreachBatch(add).option("checkpointLocation", str(tmp_path / "k")).trigger(availableNow=True).start()
        q.awaitTermination()

    once()
    n = len(catalog.referenced("message"))
    add(envelopes(spark, pages[:1]), 0)  # a repeated batch
    assert len(catalog.referenced("message")) == n == 2
    for e in pages[2:]:
        archive.put(root, e)
    once()
    want = sorted(map(tuple, P.project(envelopes(spark, pages)).collect()))
    assert sorted(map(tuple, I.state(catalog, "message").collect())) == want
    I.compact(catalog, "message", "stream", "all")
    assert len(catalog.referenced("message")) == 1 and sorted(map(tuple, catalog.scan("message").collect())) == want


def test_current_in_complete_mode(spark, pages, tmp_path):
    for e in pages:
        archive.put(str(tmp_path / "a"), e)
    q = I.current(I.read_archive(spark, str(tmp_path / "a"))).writeStream.outputMode("complete").format("memory").queryName("now").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("now").collect())) == sorted(map(tuple, P.project(envelopes(spark, pages)).collect()))


def budget_loop(requests, ceiling, window):
    budgets, out = {}, []
    for app, i, ms in sorted(requests, key=lambda r: (str(r[0]), r[2], r[1])):
        b = budgets.setdefault(app, Budget(ceiling=ceiling, window_ms=window))
        out.append((app, i, ms, b.acquire(ms)[0]))
    return sorted(out, key=str)


def test_replay_is_the_loop(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", "c", None]), i, r.randint(0, 3000)) for i in range(900)]
    d = spark.createDataFrame(rows, "app string, id long, ms long")
    assert sorted(map(tuple, I.replay(d, "app", 4, 100).collect()), key=str) == budget_loop(rows, 4, 100)
    assert I.replay(d.limit(0), "app", 4, 100).count() == 0


def test_grants_keep_state_over_batches(spark, tmp_path):
    rows = [("a", i, 10 * i) for i in range(40)] + [("b", 100 + i, 30 * i) for i in range(10)]
    d = spark.createDataFrame(rows, "app string, id long, ms long")
    for k in range(2):  # two files, in order of time
        d.where(F.col("ms") < 200 if k == 0 else F.col("ms") >= 200).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = I.grants(s, 2, 100).writeStream.format("memory").queryName("granted").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("granted").collect()), key=str) == budget_loop(rows, 2, 100)


def test_dispatches(spark):
    frames = [('{"op":0,"t":"MESSAGE_CREATE","s":3,"d":{"id":"1","channel_id":"7"}}', 1), ('{"op":11}', 2), ('{"op":0,"t":"TYPING_START","s":4,"d":{}}', 3), ('{"op":0,"t":"GUILD_UPDATE","s":5,"d":{}}', 4), ('{"op":0,"t":"MESSAGE_CREATE","s":6,"d":{"channel_id":"8"}}', 5)]
    d = spark.createDataFrame([(f"0199A1B2-0000-7000-8000-00000000000{i}", "2026-01-01T00:00:00.000Z", f, "g", "s", 0, 513) for f, i in frames], "observation_id string, observed_at string, frame string, instance_id string, session_id string, shard int, intents int")
    got = I.dispatches(d).orderBy("observation_id").collect()
    assert [(r.gateway.sequence, r.payload) for r in got] == [(3, frames[0][0]), (5, frames[3][0]), (6, frames[4][0])] and got[0].source_kind == "gateway"
    e = I.dispatches(d).withColumn("provenance", F.lit(None).cast("struct<channel_id:string>"))
    assert P.validated(e).count() == 3
    assert sorted(r.gateway.sequence for r in community.admit(e, spark.createDataFrame([("7",)], "channel_id string")).collect()) == [3, 5]


def test_admission_of_pages(spark, pages):
    e = envelopes(spark, pages)
    assert community.admit(e, spark.createDataFrame([(pages[0]["provenance"]["channel_id"],)], "channel_id string")).count() == 4
    assert community.admit(e, spark.createDataFrame([("9",)], "channel_id string")).count() == 0


SUBJECT = "300000000000000003"


def test_erasure(spark, pages):
    rest = {"id": "5", "channel_id": "2", "author": {"id": "4", "username": "v"}, "content": f"hi <@{SUBJECT}> and <@!{SUBJECT}>", "timestamp": "2026-01-01T00:00:00Z", "mentions": [{"id": SUBJECT, "username": "s"}, {"id": "6"}], "flags": 12345678901234567890, "nested": {"x": [1.50, None]}, "referenced_message": {"id": "8", "author": {"id": SUBJECT}, "content": "mine"}}
    own = rest | {"id": "7", "author": {"id": SUBJECT}}
    only_mention, clean = pages[0] | {"payload": [rest]}, pages[1] | {"payload": [rest | {"content": "x", "mentions": [], "referenced_message": None}]}
    both = pages[2] | {"payload": [own, rest]}
    e = envelopes(spark, [only_mention, clean, both])
    got = {r.observation_id: r for r in erasure.erase(e, SUBJECT, "run 1").collect()}
    one, two, three = (got[x["observation_id"]] for x in (only_mention, clean, both))
    assert one.erased and one.erasure_run == "run 1" and not two.erased and two.erasure_run is None and two.payload == archive.payload_text(clean)
    want = rest | {"content": "hi <@erased> and <@!erased>", "mentions": [{"id": "6"}], "referenced_message": None}
    assert json.loads(one.payload) == [want] == json.loads(three.payload) and one.provenance == e.where(F.col("observation_id") == one.observation_id).first().provenance
    assert erasure.remaining(e, SUBJECT) == 2 and erasure.remaining(erasure.erase(e, SUBJECT), SUBJECT) == 0
    assert erasure.erase(e, "30000000000000000").where("erased").count() == 0  # a part of an id is none
    with pytest.raises(ValueError):
        erasure.erase(e, ".*")


def test_suppression(spark):
    d = spark.createDataFrame([("1",), ("2",), (None,), ("é",)], "subject string")
    for key in (b"k", b"x" * 100):
        got = {r.subject: r.token for r in d.withColumn("token", S.subject_tokens(key, F.col("subject"))).collect()}
        assert got == {s: None if s is None else hmac.new(key, s.encode(), hashlib.sha256).hexdigest() for s in ("1", "2", None, "é")} and got["1"] == S.subject_token(key, "1")
    marks = erasure.mark_suppressed(d.where("subject = '2'"), b"k")
    assert marks.columns == ["token"] and sorted(r.subject or "" for r in erasure.suppress(d.withColumn("token", S.subject_tokens(b"k", F.col("subject"))), marks).collect()) == ["", "1", "é"]


def test_relations(spark, pages):
    m = {"id": "5", "channel_id": "2", "thread": {"id": "9", "parent_id": "2"}, "attachments": [{"id": "a1"}, {"id": "a2"}], "reactions": [{"emoji": {"id": None, "name": "+"}}], "message_reference": {"message_id": "4"}}
    got = community.relations(envelopes(spark, [pages[0] | {"payload": [m, {"id": "6", "channel_id": "2"}]}, pages[1] | {"payload": [m]}]))
    assert sorted(map(tuple, got.collect())) == [("5", "answers", "4"), ("5", "attachment", "a1"), ("5", "attachment", "a2"), ("5", "channel", "2"), ("5", "reaction", "+"), ("5", "thread", "9"), ("5", "thread_parent", "2"), ("6", "channel", "2")]
    known = spark.createDataFrame([("5", "c"), ("6", "d")], "message_id string, content string")
    assert [tuple(r) for r in community.related(known, got, "answers").collect()] == [("5", "c", "4")]
    b = spark.createDataFrame([("r", 1, "x"), ("r", 2, "y"), ("q", 1, "z")], "route_key string, observed_at long, bucket string")
    assert sorted(map(tuple, community.latest_buckets(b).collect())) == [("q", 1, "z"), ("r", 2, "y")]


@pytest.fixture(scope="module")
def service():
    """A server of seven messages, and of a SQL engine."""

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def answer(self, status, body, **headers):
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k.replace("_", "-"), v)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            path, _, query = self.path.partition("?")
            asked = dict(x.split("=") for x in query.split("&"))
            if "/channels/404/" in path:
                return self.answer(404, b"{}")
            if self.headers["Authorization"] != "Bot t":
                return self.answer(401, b"{}", x_ratelimit_scope="user")
            top = int(asked["before"]) - 1 if "before" in asked else 106
            body = [{"id": str(i), "content": "é"} for i in range(top, max(99, top - int(asked["limit"])), -1)]
            self.answer(200, json.dumps(body).encode(), x_ratelimit_remaining="0", x_ratelimit_reset_after="0.5")

        def do_POST(self):
            sql = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["query"]
            if sql == "bad":
                return self.answer(500, b"x" * 600)
            self.answer(200, json.dumps({"success": True, "errors": [], "result": {"rows": [{"q": sql, "t": self.headers["Authorization"]}]}}).encode())

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_page_client(service):
    r = PageClient(service, "t").fetch("5", "104", 3)
    assert r.status == 200 and [m["id"] for m in json.loads(r.body)] == ["103", "102", "101"] and r.headers["remaining"] == 0 and r.headers["reset_after"] == 0.5
    assert PageClient(service, "t").fetch("404", None, 3).status == 404
    r = PageClient(service, "wrong").fetch("5", None, 3)
    assert r.status == 401 and r.headers["scope"] == "user"
    with pytest.raises(OSError):
        PageClient("http://127.0.0.1:1", "t").fetch("5", None, 3)


def test_page_source(spark, service, tmp_path):
    spark.dataSource.register(PagedSource)
    seen = []

    def keep(batch, n):
        seen.extend((n, r.before, r.payload) for r in batch.collect())

    q = spark.readStream.format("pages").options(url=service, token="t", channel="5", limit="3").load().writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "k")).start()
    try:
        for _ in range(100):
            q.processAllAvailable()
            if len(seen) >= 3:
                break
    finally:
        q.stop()
    assert [m["id"] for _, _, p in sorted(seen) for m in json.loads(p)] == [str(i) for i in range(106, 99, -1)] and [b for _, b, _ in sorted(seen)] == [None, "104", "101"]


def test_remote_sql(service):
    a = RemoteSql(service, "s").query("select 1")
    assert a.rows == [{"q": "select 1", "t": "Bearer s"}] and a.status == 200
    with pytest.raises(RuntimeError, match=r"status 500: x{512}\.\.\.$"):
        RemoteSql(service, "s").query("bad")
    assert rows_of(b'[{"a":1}]') == rows_of(b'{"rows":[{"a":1}]}') == rows_of(b'{"results":[{"a":1}]}') == rows_of(b'{"result":[{"a":1}],"success":true}') == [{"a": 1}]
    for bad, kind in ((b"{", ValueError), (b"[1]", ValueError), (b'{"success":false,"errors":["e"],"result":{}}', RuntimeError)):
        with pytest.raises(kind):
            rows_of(bad)


def test_scalars_of_headers_and_times(spark):
    def one(*c):
        return tuple(spark.range(1).select(*c).first())

    t = [F.lit(x) for x in ("NaN", "Infinity", "", " 2 ", "1e2", "x")]
    assert one(*map(S.header_number, t)) == (None, None, 0.0, 2.0, 100.0, None)
    assert one(S.header_flag(F.lit("true")), S.header_flag(F.lit("TRUE")), S.header_flag(F.lit(None))) == (True, False, False)
    got = one(*[S.utc_text(S.instant(F.lit(x))) for x in ("2026-01-01T00:00:00Z", "2026-01-01T02:00:00.123456789+02:00", "2026-01-01T00:00:00", "2026-13-01T00:00:00Z", "2026-01-01")])
    assert got == ("2026-01-01T00:00:00.000Z", "2026-01-01T00:00:00.123Z", None, None, None)
    assert (S.positive_int("5", 1), S.positive_int("0", 1), S.positive_int(None, 1), S.boolean("TRUE", False), S.boolean(None, True)) == (5, 1, 1, True, True)
    assert S.cut_text("é" * 300) == "é" * 256 + "..." and S.cut_text("a") == "a"
