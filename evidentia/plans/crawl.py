"""Backfill crawl: keyset pages, request budget and the run's state machine.

The rules are plain functions of state. A page takes a budget slot, is fetched, classified, committed to the archive,
and only then moves the cursor: a crash gives duplicates, never loss. What follows from a page is an Outcome, and
`apply` makes the next state of it; `Channel` keeps that state in a control store, one object a channel, so that each
step is one write and a restart finds cursor, attempt, pending report and wake-up time as they were."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import uuid7
from ..operators.projection import best_known
from ..sources import archive
from ..sources.control import ControlStore

ACTIVE, TERMINAL = ("running", "waiting"), ("completed", "failed", "halted")
ROUTE = "GET /channels/{channel_id}/messages"
FAULTS = ("after_fetch_before_archive", "after_archive_before_progress", "after_progress_before_alarm", "after_coordination_report_before_transition")


def parse_id(value) -> str | None:
    return value if isinstance(value, str) and re.fullmatch(r"[0-9]{1,20}", value) and int(value) < 1 << 64 else None


def min_id(ids: Sequence[str]) -> str | None:
    return min(ids, key=int, default=None)


def advance(ids: Sequence[str], limit: int, after: str | None) -> tuple[str | None, bool]:
    """(next cursor, complete) of a page asked for by `before`, newest first."""
    low = min_id(ids)
    return low, low is None or (after is not None and int(low) <= int(after)) or len(ids) < limit


def backoff(attempt: int) -> int:
    return min(300_000, 2000 * 2 ** min(attempt, 10))


def classify(status: int) -> str:
    return "success" if 200 <= status < 300 else {401: "unauthorized", 403: "forbidden", 404: "not_found", 429: "rate_limited"}.get(status, "client_error" if 400 <= status < 500 else "server_error")


def number(text: str | None) -> float | None:
    """A header's finite number; 0 for blanks."""
    if text is None:
        return None
    if not text.strip():
        return 0.0
    try:
        x = float(text) if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text.strip()) else math.nan
    except ValueError:
        return None
    return x if math.isfinite(x) else None


def parse_headers(headers) -> dict:
    """Rate-limit headers (any mapping with get, names in lower case)."""
    scope = headers.get("x-ratelimit-scope")
    return {
        "limit": number(headers.get("x-ratelimit-limit")), "remaining": number(headers.get("x-ratelimit-remaining")), "reset_after": number(headers.get("x-ratelimit-reset-after")), "bucket": headers.get("x-ratelimit-bucket"),
        "global": headers.get("x-ratelimit-global") == "true", "scope": scope if scope in ("user", "global", "shared") else None, "retry_after": number(headers.get("retry-after")),
    }


def retry_after(headers: dict, body) -> int:
    for x in (body.get("retry_after") if isinstance(body, dict) else None, headers.get("retry_after")):
        if isinstance(x, int | float) and not isinstance(x, bool) and math.isfinite(x) and x >= 0:
            return math.ceil(x * 1000)
    return 1000


def next_eligible(done_ms: int, headers: dict) -> int:
    reset = headers.get("reset_after")
    return done_ms + math.ceil(reset * 1000) if headers.get("remaining") == 0 and reset is not None else done_ms


def route_bucket(done_ms: int, headers: dict) -> dict:
    """What the last response said about its route; kept by route, the last one wins."""
    reset = headers.get("reset_after")
    return {"route_key": ROUTE, "bucket": headers.get("bucket"), "limit": headers.get("limit"), "remaining": headers.get("remaining"), "reset_at": None if reset is None else done_ms + math.ceil(reset * 1000), "observed_at": done_ms}


def validate_start(body, page_limit: int = 100) -> dict:
    """A start request, or ValueError that says what is wrong."""
    if not isinstance(body, dict):
        raise ValueError("body must be an object")
    span = body.get("range") or {}
    out = {"guild_id": body.get("guild_id"), "channel_id": body.get("channel_id"), "before": span.get("before"), "after": span.get("after"), "page_limit": body.get("page_limit", page_limit)}
    for k in ("guild_id", "channel_id"):
        if parse_id(out[k]) is None:
            raise ValueError(f"{k} must be an id")
    for k in ("before", "after"):
        if k in span and parse_id(out[k]) is None:
            raise ValueError(f"range.{k} must be an id")
    if out["before"] is not None and out["after"] is not None and int(out["after"]) >= int(out["before"]):
        raise ValueError("range.after must be below range.before")
    if not isinstance(out["page_limit"], int) or isinstance(out["page_limit"], bool) or not 1 <= out["page_limit"] <= 100:
        raise ValueError("page_limit must be an integer from 1 to 100")
    return out


@dataclass
class Budget:
    """Sliding windows of granted and invalid requests, pauses, and a halt for refused credentials."""

    ceiling: int = 50
    window_ms: int = 1000
    invalid_budget: int = 10_000
    invalid_window_ms: int = 600_000
    stop_share: float = 0.9
    slots: list[int] = field(default_factory=list)
    invalid: list[int] = field(default_factory=list)
    reports: dict[str, int] = field(default_factory=dict)
    paused_until: int = 0
    halted: bool = False

    def prune(self, now: int) -> None:
        self.slots = [t for t in self.slots if t > now - self.window_ms]
        self.invalid = [t for t in self.invalid if t > now - self.invalid_window_ms]
        self.reports = {k: t for k, t in self.reports.items() if t > now - self.invalid_window_ms}

    def acquire(self, now: int) -> tuple[bool, str | None, int]:
        """(granted, reason, retry after ms); only a grant takes a slot."""
        self.prune(now)
        if self.halted:
            return False, "credential_halt", self.invalid_window_ms
        if now < self.paused_until:
            return False, "global_retry_after", self.paused_until - now
        if len(self.invalid) >= math.floor(self.stop_share * self.invalid_budget):
            return False, "invalid_request_budget", max(1000, min(self.invalid, default=now) + self.invalid_window_ms - now)
        if len(self.slots) >= self.ceiling:
            return False, "global_ceiling", max(1, min(self.slots, default=now) + self.window_ms - now)
        self.slots.append(now)
        return True, None, 0

    def report(self, report_id: str, now: int, status: int, scope: str | None = None, is_global: bool = False, retry_ms: int | None = None) -> None:
        """Counts a response once, however often it is reported."""
        self.prune(now)
        if report_id in self.reports:
            return
        self.reports[report_id] = now
        if status in (401, 403) or status == 429 and scope != "shared":
            self.invalid.append(now)
        if status == 429 and (is_global or scope == "global"):
            self.paused_until = max(self.paused_until, now + (1000 if retry_ms is None else retry_ms))
        if status == 401:
            self.halted = True

    def clear_halt(self) -> None:
        """After the credential was changed."""
        self.halted = False

    def snapshot(self, now: int) -> dict:
        self.prune(now)
        return {"requests_in_window": len(self.slots), "invalid_in_window": len(self.invalid), "paused_until": self.paused_until, "halted": self.halted}


class DurableBudget:
    """A Budget whose every change is written before it is answered."""

    def __init__(self, control: ControlStore, key: str = "crawl/budget.json", **limits):
        self.control, self.key, self.limits = control, key, limits

    def _with(self, work: Callable):
        b = Budget(**((self.control.get(self.key) or {}) | self.limits))
        out = work(b)
        self.control.put(self.key, asdict(b))
        return out

    def acquire(self, now: int) -> tuple[bool, str | None, int]:
        return self._with(lambda b: b.acquire(now))

    def report(self, report_id: str, now: int, status: int, scope: str | None = None, is_global: bool = False, retry_ms: int | None = None) -> None:
        self._with(lambda b: b.report(report_id, now, status, scope, is_global, retry_ms))

    def clear_halt(self) -> None:
        self._with(lambda b: b.clear_halt())

    def snapshot(self, now: int) -> dict:
        return self._with(lambda b: b.snapshot(now))


@dataclass(frozen=True)
class Run:
    run_id: str
    guild_id: str
    channel_id: str
    page_limit: int = 100
    before: str | None = None
    after: str | None = None
    cursor: str | None = None
    state: str = "running"
    pages: int = 0
    attempt: int = 0
    next_at: int = 0
    pending: dict | None = None  # a report not yet delivered, and what follows it
    error: dict | None = None
    last_observation: str | None = None
    last_key: str | None = None
    created_at: int = 0
    updated_at: int = 0

    def request_before(self) -> str | None:
        return self.cursor if self.cursor is not None else self.before


@dataclass(frozen=True)
class Response:
    status: int
    headers: dict  # as parse_headers gives them
    body: bytes
    started_ms: int
    done_ms: int


@dataclass(frozen=True)
class Outcome:
    """kind: archived, deferred, retry, terminal, pending (a report to deliver first), resolved (it is delivered)."""

    kind: str
    at: int = 0  # when the next request may go out
    reason: str = ""
    cursor: str | None = None
    completed: bool = False
    observation: str | None = None
    key: str | None = None
    bucket: dict | None = None
    error: dict | None = None
    report: dict | None = None
    then: dict | None = None  # the outcome that a delivered report leads to
    failed: bool = False  # its delivery was tried


class Crash(Exception):
    """Raised by tests' fault hooks; nothing here catches it."""


class Pages(Protocol):
    def fetch(self, channel_id: str, before: str | None, limit: int) -> Response: ...


class Gate(Protocol):
    def acquire(self, now: int) -> tuple[bool, str | None, int]: ...

    def report(self, report_id: str, now: int, status: int, scope: str | None, is_global: bool, retry_ms: int | None) -> None: ...


@dataclass
class Ports:
    """What a crawl touches; tests put fakes in."""

    pages: Pages
    budget: Gate
    commit: Callable[[dict], str]  # envelope -> result; ValueError: the archive holds another observation
    now: Callable[[], int]
    seed: Callable[[], bytes]  # random bytes for ids
    fault: Callable[[str], None] = lambda point: None
    source_kind: str = "http_backfill"  # http_reconciliation: pages are observed again, and always added
    api_version: str = "10"
    capabilities: dict = field(default_factory=lambda: {"message_content": True})


def wire(ms: int) -> str:
    return archive.wire_time(datetime.fromtimestamp(ms / 1000, UTC))


def failure(kind: str, status: int | None, message: str, at: int) -> dict:
    return {"kind": kind, "http_status": status, "message": message, "occurred_at": wire(at)}


def message_ids(body: bytes) -> list[str]:
    """Ids of a page's messages; ValueError for anything that is no page."""
    page = json.loads(body.decode("utf-8"))
    if not isinstance(page, list):
        raise ValueError("page is no array")
    ids = [parse_id(m.get("id")) if isinstance(m, dict) else None for m in page]
    if any(x is None for x in ids):
        raise ValueError("message without id")
    return ids


def envelope_of(run: Run, r: Response, observation: str, ports: Ports) -> dict:
    """The observation of a page; raw keeps the payload's bytes as they came."""
    raw = r.body.decode("utf-8").removeprefix("\ufeff").strip()
    return {
        "envelope_version": "v1", "observation_id": observation, "source_kind": ports.source_kind, "observed_at": wire(r.done_ms), "payload": json.loads(raw), "raw": raw,
        "provenance": {
            "run_id": run.run_id, "discord_api_version": ports.api_version, "guild_id": run.guild_id, "channel_id": run.channel_id, "operation": "get_channel_messages", "endpoint": f"/channels/{run.channel_id}/messages",
            "pagination": {"before": run.request_before(), "after": None}, "limit": run.page_limit, "request_started_at": wire(r.started_ms), "response_completed_at": wire(r.done_ms), "http_status": r.status,
            "capabilities": ports.capabilities, "rate_limit": {"limit": r.headers.get("limit"), "remaining": r.headers.get("remaining"), "reset_after_seconds": r.headers.get("reset_after"), "bucket": r.headers.get("bucket")},
        },
    }


def page(run: Run, ports: Ports) -> Outcome:
    """One request and what follows from it."""
    now = ports.now()
    ok, reason, wait = ports.budget.acquire(now)
    if not ok:
        return Outcome("deferred", now + wait, reason)
    report_id = uuid7(now, ports.seed())
    try:
        r = ports.pages.fetch(run.channel_id, run.request_before(), run.page_limit)
    except Crash:
        raise
    except Exception as e:
        return Outcome("retry", now + backoff(run.attempt), f"transport: {e}")

    def report(retry: int | None) -> dict:
        return {"report_id": report_id, "status": r.status, "scope": r.headers.get("scope"), "is_global": bool(r.headers.get("global")), "retry_ms": retry}

    kind = classify(r.status)
    if kind in ("unauthorized", "forbidden", "rate_limited"):
        # these feed the budget that all runs share: kept first, then told, and nothing else goes out before
        retry = None
        if kind == "rate_limited":
            try:
                body = json.loads(r.body)
            except ValueError:
                body = None
            retry = retry_after(r.headers, body)
            then = {"kind": "deferred", "at": r.done_ms + retry}
        else:
            name = "credential_failure" if kind == "unauthorized" else "scope_inaccessible"
            then = {"kind": "terminal", "error": failure(name, r.status, kind, r.done_ms)}
        return Outcome("pending", ports.now(), report=report(retry), then=then)
    try:
        ports.budget.report(now=ports.now(), **report(None))  # only for diagnosis: a lost one holds nothing up
    except Crash:
        raise
    except Exception:  # noqa: S110
        pass
    if kind == "server_error":
        return Outcome("retry", r.done_ms + backoff(run.attempt), f"status {r.status}")
    if kind != "success":
        return Outcome("terminal", error=failure("scope_not_found" if kind == "not_found" else "invalid_request", r.status, kind, r.done_ms))
    ports.fault("after_fetch_before_archive")
    observation = uuid7(r.done_ms, ports.seed())
    try:
        ids = message_ids(r.body)
        env = envelope_of(run, r, observation, ports)
    except ValueError as e:
        return Outcome("terminal", error=failure("invalid_request", r.status, f"page can't be read: {e}", r.done_ms))
    try:
        ports.commit(env)
    except Crash:
        raise
    except ValueError as e:
        return Outcome("terminal", error=failure("archive_invariant_violation", None, str(e), r.done_ms))
    except Exception as e:
        return Outcome("retry", now + backoff(run.attempt), f"archive: {e}")
    low, done = advance(ids, run.page_limit, run.after)
    return Outcome("archived", next_eligible(r.done_ms, r.headers), cursor=low, completed=done, observation=observation, key=archive.key_of(env), bucket=route_bucket(r.done_ms, r.headers))


def deliver(run: Run, ports: Ports) -> Outcome:
    """Tells the budget what is pending."""
    try:
        ports.budget.report(now=ports.now(), **run.pending["report"])
    except Crash:
        raise
    except Exception as e:
        return Outcome("pending", ports.now() + backoff(run.attempt), str(e), report=run.pending["report"], then=run.pending["then"], failed=True)
    ports.fault("after_coordination_report_before_transition")
    return Outcome("resolved", then=run.pending["then"])


def apply(run: Run, o: Outcome, now: int) -> Run:
    """The run after an outcome."""

    def ended(error: dict) -> Run:
        return replace(run, state="halted" if error["kind"] == "credential_failure" else "failed", error=error, pending=None, updated_at=now)

    if o.kind == "archived":
        return replace(run, state="completed" if o.completed else "running", cursor=run.cursor if o.completed else o.cursor, pages=run.pages + 1, attempt=0, next_at=o.at, last_observation=o.observation, last_key=o.key, updated_at=now)
    if o.kind == "deferred":
        if o.reason == "credential_halt":
            return ended(failure("credential_failure", None, "the budget is halted", now))
        return replace(run, state="waiting", next_at=o.at, updated_at=now)
    if o.kind == "retry":
        return replace(run, state="running", attempt=run.attempt + 1, next_at=o.at, updated_at=now)
    if o.kind == "pending":
        return replace(run, state="waiting", pending={"report": o.report, "then": o.then}, next_at=o.at, attempt=run.attempt + o.failed, updated_at=now)
    if o.kind == "resolved":
        if o.then["kind"] == "terminal":
            return ended(o.then["error"])
        return replace(run, state="waiting", pending=None, next_at=o.then["at"], updated_at=now)
    return ended(o.error)


def current_runs(runs: DataFrame, active: Sequence[str] = ACTIVE) -> DataFrame:
    """Each channel's run of a table of runs: the active one, else the last one made."""
    return best_known(runs.withColumn("is_active", F.col("state").isin(*active)), "channel_id", ("is_active", "created_at", "run_id")).drop("is_active")


class Channel:
    """The runs of one channel, at most one of them active, with their wake-up time and route buckets: one object in the
    control store, replaced at each step. Opening a channel sets the wake-up of an active run that lost it."""

    def __init__(self, control: ControlStore, channel_id: str, ports: Ports, most: int = 5):
        self.control, self.key, self.ports, self.most = control, f"crawl/channel-{channel_id}.json", ports, most
        self.resume()

    def _load(self) -> dict:
        return self.control.get(self.key) or {"runs": {}, "wake_at": None, "buckets": {}}

    @staticmethod
    def _active(state: dict) -> Run | None:
        return next((Run(**r) for r in state["runs"].values() if r["state"] in ACTIVE), None)

    def start(self, body: dict) -> tuple[bool, Run]:
        """(True, new run), or (False, the active one)."""
        state = self._load()
        if (active := self._active(state)) is not None:
            return False, active
        now = self.ports.now()
        run = Run(uuid7(now, self.ports.seed()), body["guild_id"], body["channel_id"], body["page_limit"], body["before"], body["after"], next_at=now, created_at=now, updated_at=now)
        state["runs"][run.run_id] = asdict(run)
        self.control.put(self.key, state | {"wake_at": now})
        return True, run

    def active(self) -> Run | None:
        return self._active(self._load())

    def status(self, run_id: str) -> Run | None:
        r = self._load()["runs"].get(run_id)
        return None if r is None else Run(**r)

    def list(self) -> list[Run]:
        """Newest first."""
        return sorted((Run(**r) for r in self._load()["runs"].values()), key=lambda r: -r.created_at)

    def current(self) -> Run | None:
        return self.active() or next(iter(self.list()), None)

    def wake_at(self) -> int | None:
        return self._load()["wake_at"]

    def buckets(self) -> dict:
        return self._load()["buckets"]

    def resume(self) -> bool:
        """Sets the wake-up time of an active run that has none; True if a run is active."""
        state = self._load()
        run = self._active(state)
        if run is not None and state["wake_at"] is None:
            self.control.put(self.key, state | {"wake_at": max(run.next_at, self.ports.now())})
        return run is not None

    def tick(self) -> Run | None:
        """A wake-up: at most `most` pages, until the run must wait or ends. The wake-up time is taken first, and set
        again last, so a crash in between is mended by resume."""
        state = self._load()
        run = self._active(state)
        if run is None:
            return None
        self.control.put(self.key, state := state | {"wake_at": None})
        for _ in range(self.most):
            if self.ports.now() < run.next_at:
                break
            try:
                o = page(run, self.ports) if run.pending is None else deliver(run, self.ports)
            except Crash:
                raise
            except Exception as e:
                o = Outcome("retry", self.ports.now() + backoff(run.attempt), f"unexpected: {e}")
            if o.kind == "archived":
                self.ports.fault("after_archive_before_progress")
            run = apply(run, o, self.ports.now())
            state["runs"][run.run_id] = asdict(run)
            if o.bucket is not None:
                state["buckets"][o.bucket["route_key"]] = o.bucket
            self.control.put(self.key, state)
            self.ports.fault("after_progress_before_alarm")
            if o.kind == "pending" and not o.failed:
                continue  # tell the budget at once
            if o.kind != "archived" or o.completed:
                break
        if run.state in ACTIVE:
            self.control.put(self.key, state | {"wake_at": run.next_at})
        return run
