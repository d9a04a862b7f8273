"""The crawl's state machine: pages, budget, crashes, refusals, the control interface and identify leases."""

import io
import json

import pytest

from evidentia.plans import api, crawl
from evidentia.plans.identify import Coordinator
from evidentia.sources import archive
from evidentia.sources.control import ControlStore
from evidentia.sources.store import LocalStore


class World:
    """A service of seven messages, an archive, and a clock that moves by hand."""

    def __init__(self, tmp_path, answers=()):
        self.time, self.sent, self.answers, self.count = 1_700_000_000_000, [], list(answers), 0
        self.control, self.store = ControlStore(str(tmp_path / "c")), LocalStore(str(tmp_path / "a"))
        self.crash = None
        self.budget = crawl.DurableBudget(self.control)
        self.lost = 0  # reports that fail

    def fetch(self, channel, before, limit):
        self.sent.append(before)
        a = self.answers.pop(0) if self.answers else None
        if isinstance(a, Exception):
            raise a
        top = 1_000_006 if before is None else int(before) - 1
        body = [{"id": str(i)} for i in range(top, max(999_999, top - limit), -1)]
        status, headers, body = (a or (200, {}, body)) if a is None or len(a) == 3 else (*a, None)
        return crawl.Response(status, crawl.parse_headers(headers), body if isinstance(body, bytes) else json.dumps(body).encode(), self.time, self.time)

    def acquire(self, now):
        return self.budget.acquire(now)

    def report(self, **x):
        if self.lost:
            self.lost -= 1
            raise OSError("no answer")
        self.budget.report(**x)

    def seed(self):
        self.count += 1
        return str(self.count).encode()

    def fault(self, point):
        assert point in crawl.FAULTS
        if self.crash == point:
            self.crash = None
            raise crawl.Crash(point)

    def channel(self, most=5, kind="http_backfill"):
        return crawl.Channel(self.control, "2", crawl.Ports(self, self, lambda env: archive.put(self.store, env), lambda: self.time, self.seed, self.fault, kind), most)

    def start(self):
        return self.channel().start(crawl.validate_start({"guild_id": "1", "channel_id": "2", "page_limit": 3}))

    def pages(self):
        return [[m["id"] for m in archive.get(self.store, k)["payload"]] for k, _ in self.store.list()]


@pytest.fixture
def world(tmp_path):
    def make(*answers):
        w = World(tmp_path, answers)
        w.start()
        return w

    return make


def test_completes(world):
    w = world()
    run = w.channel().tick()
    assert run.state == "completed" and w.sent == [None, "1000004", "1000001"] and run.pages == 3 and sum(map(len, w.pages())) == 7
    env = archive.get(w.store, run.last_key)
    assert env["observation_id"] == run.last_observation and env["provenance"]["pagination"] == {"before": "1000001", "after": None}
    assert w.channel().wake_at() is None and w.channel().tick() is None and w.budget.snapshot(w.time)["requests_in_window"] == 3


def test_reconciliation_observes_again(world):
    w = world()
    w.channel().tick()
    n = len(w.store.list())
    w.time += 60_000
    assert w.start()[0] and w.channel(kind="http_reconciliation").tick().state == "completed"
    kinds = [archive.get(w.store, k)["source_kind"] for k, _ in w.store.list()]
    assert kinds.count("http_reconciliation") == kinds.count("http_backfill") == n


def test_one_active_run_and_pages_a_tick(world):
    w = world()
    fresh, active = w.channel().start({"guild_id": "1", "channel_id": "2", "page_limit": 3, "before": None, "after": None})
    assert not fresh and w.channel(1).tick().pages == 1 and w.channel().current().run_id == active.run_id and w.channel().wake_at() == w.time


def test_range(world):
    assert crawl.advance(["5", "10", "9"], 3, "5") == ("5", True) and crawl.advance(["9", "10"], 2, None) == ("9", False) and crawl.advance([], 3, None) == (None, True)


@pytest.mark.parametrize("point", crawl.FAULTS[:3])
def test_crashes_give_duplicates_never_loss(world, point):
    w = world()
    w.crash = point
    with pytest.raises(crawl.Crash):
        w.channel().tick()
    assert w.control.get("crawl/channel-2.json")["wake_at"] is None  # lost
    assert w.channel().wake_at() == w.time  # set again by opening
    assert w.channel().tick().state == "completed"
    assert {i for p in w.pages() for i in p} == {str(1_000_000 + i) for i in range(7)}


@pytest.mark.parametrize(("status", "state", "error", "wait"), [(401, "halted", "credential_failure", 0), (403, "failed", "scope_inaccessible", 0), (404, "failed", "scope_not_found", 0), (418, "failed", "invalid_request", 0), (429, "waiting", None, 2500), (500, "running", None, 2000)])
def test_refusals(world, status, state, error, wait):
    w = world((status, {}, {"retry_after": 2.5}))
    run = w.channel().tick()
    assert run.state == state and not w.pages() and run.pending is None and (run.error or {}).get("kind") == error
    assert run.next_at == w.time + wait
    if error is None:
        assert w.channel().wake_at() == w.time + wait and w.channel().tick() == w.channel().active()
        w.time += wait
        assert w.channel().tick().state == "completed"
    assert w.budget.snapshot(w.time)["invalid_in_window"] == (status in (401, 403, 429))


@pytest.mark.parametrize("status", [401, 403, 429])
def test_report_goes_first(world, status):
    w = world((status, {}, {}))
    w.lost = 2
    run = w.channel().tick()
    assert run.state == "waiting" and run.pending["report"]["status"] == status and run.attempt == 1 and len(w.sent) == 1
    w.time = run.next_at
    run = w.channel().tick()  # fails again; no request went out
    assert run.attempt == 2 and run.next_at == w.time + 4000 and len(w.sent) == 1
    w.time = run.next_at
    w.crash = "after_coordination_report_before_transition"
    with pytest.raises(crawl.Crash):
        w.channel().tick()
    run = w.channel().tick()  # the report is sent again and counts once
    assert run.state == {401: "halted", 403: "failed", 429: "waiting"}[status] and run.pending is None and len(w.sent) == 1
    assert w.budget.snapshot(w.time)["invalid_in_window"] == 1


def test_lost_advice_holds_nothing_up(world):
    w = world()
    w.lost = 100
    assert w.channel().tick().state == "completed"


def test_transport_archive_and_bad_pages(world):
    w = world(OSError("down"))
    run = w.channel().tick()
    assert run.state == "running" and run.attempt == 1 and run.next_at == w.time + 2000
    w.time += 2000
    w.answers = [(200, {}, b"{}")]
    run = w.channel().tick()
    assert run.state == "failed" and run.error["kind"] == "invalid_request"


def test_halted_budget_ends_runs(world):
    w = world()
    w.budget.report("r", w.time, 401)
    assert w.channel().tick().state == "halted"
    w.budget.clear_halt()
    assert w.start()[0] and w.channel().tick().state == "completed"
    assert [r.state for r in w.channel().list()] == ["completed", "halted"] or len(w.channel().list()) == 2


def test_rate_headers_and_buckets(world):
    w = world((200, {"x-ratelimit-remaining": "0", "x-ratelimit-reset-after": "1.5", "x-ratelimit-bucket": "b", "x-ratelimit-limit": "5"}, [{"id": "9"}, {"id": "8"}, {"id": "7"}]))
    run = w.channel().tick()
    assert run.next_at == w.time + 1500 and w.channel().buckets()[crawl.ROUTE] == {"route_key": crawl.ROUTE, "bucket": "b", "limit": 5.0, "remaining": 0.0, "reset_at": w.time + 1500, "observed_at": w.time}
    assert [crawl.number(x) for x in ("NaN", "Infinity", "", " 2 ", "x", None, "1e2")] == [None, None, 0.0, 2.0, None, None, 100.0]


def test_budget():
    b = crawl.Budget(ceiling=2, window_ms=10)
    assert [b.acquire(t)[0] for t in (0, 1, 2, 9, 10, 11, 12)] == [True, True, False, False, True, True, False]
    b.report("x", 20, 429, None, True, 100)
    b.report("x", 25, 429, None, True, 100)
    assert b.acquire(119) == (False, "global_retry_after", 1) and b.acquire(120)[0] and len(b.invalid) == 1
    b = crawl.Budget()
    b.report("y", 0, 429, "global")
    assert b.acquire(0) == (False, "global_retry_after", 1000)
    b = crawl.Budget(invalid_budget=3, invalid_window_ms=2000)
    b.report("a", 0, 403)
    b.report("b", 5, 429, "shared")
    assert b.acquire(5)[0]
    b.report("c", 6, 429, "user")
    assert b.acquire(1500) == (False, "invalid_request_budget", 1000) and b.acquire(2000)[0]


def test_start_requests():
    good = {"guild_id": "1", "channel_id": "2"}
    assert crawl.validate_start(good)["page_limit"] == 100 and crawl.validate_start(good | {"range": {"after": "9", "before": "10"}})["after"] == "9"
    for bad in ([], {"guild_id": 1, "channel_id": "2"}, good | {"channel_id": "x"}, good | {"range": {"after": "10", "before": "9"}}, good | {"range": {"before": None}}, good | {"page_limit": 0}, good | {"page_limit": 101}, good | {"page_limit": True}, good | {"guild_id": str(1 << 64)}):
        with pytest.raises(ValueError):
            crawl.validate_start(bad)


def test_interface(tmp_path):
    w = World(tmp_path)
    app = api.application("secret", lambda channel: w.channel())

    def ask(method, path, body=b"", token="Bearer secret"):
        said = []
        env = {"REQUEST_METHOD": method, "PATH_INFO": path, "CONTENT_LENGTH": str(len(body)), "wsgi.input": io.BytesIO(body)} | ({"HTTP_AUTHORIZATION": token} if token else {})
        out = b"".join(app(env, lambda status, headers: said.append(status)))
        return int(said[0][:3]), json.loads(out)

    assert ask("GET", "/healthz", token=None) == (200, {"ok": True})
    for token in (None, "Bearer wrong", "secret"):
        assert ask("POST", "/v1/backfill/runs", b"{}", token)[0] == 401
    assert api.handle("GET", "/v1/backfill/channels/2", "Bearer ", b"", None, lambda c: w.channel())[0] == 401
    assert ask("POST", "/v1/backfill/runs", b"{")[0] == 400 and ask("POST", "/v1/backfill/runs", b"[]")[0] == 400 and ask("POST", "/v1/backfill/runs", b'{"guild_id":"1"}')[0] == 400
    assert ask("GET", "/v1/backfill/channels/2")[0] == 404
    start = json.dumps({"guild_id": "1", "channel_id": "2", "page_limit": 3}).encode()
    status, made = ask("POST", "/v1/backfill/runs", start)
    ident = made["run"]["run_id"]
    assert status == 202 and ask("POST", "/v1/backfill/runs", start)[0] == 409
    assert ask("GET", f"/v1/backfill/channels/2/runs/{ident}")[1]["run"]["state"] == "running" and ask("GET", "/v1/backfill/channels/2/runs/0")[0] == 404
    assert ask("POST", "/v1/backfill/channels/2/resume") == (200, {"scheduled": True}) and w.channel().tick().state == "completed"
    assert ask("POST", "/v1/backfill/channels/2/resume") == (200, {"scheduled": False}) and ask("GET", "/v1/backfill/channels/2")[1]["run"]["state"] == "completed" and ask("GET", "/nowhere")[0] == 404


def test_identify_leases(tmp_path):
    c = Coordinator()
    assert c.acquire("a", "i", 0, 0)[1] == "limits_unknown"
    c.limits(10, 2, 86_400_000, 2, 0)
    assert c.acquire("a", "i", 0, 0)[0] and c.acquire("a", "i", 0, 1)[0] and c.remaining == 1
    assert c.acquire("b", "j", 2, 1000) == (False, "bucket_window", 4000) and c.acquire("c", "j", 1, 1000)[0] and c.remaining == 0
    assert c.acquire("d", "j", 2, 5000) == (False, "daily_budget", 86_395_000)
    control = ControlStore(str(tmp_path))
    c.sent("a")
    c.save(control)
    c = Coordinator.load(control)
    assert c.acquire("d", "j", 2, 31_000)[0] and c.remaining == 0  # the unused lease of c came back
    c.refused()
    assert c.acquire("e", "j", 1, 40_000)[1] == "limits_unknown"
