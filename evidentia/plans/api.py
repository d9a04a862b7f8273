"""The crawl's control interface as a WSGI application, for any server that speaks it."""

from __future__ import annotations

import hmac
import json
import re
from collections.abc import Callable
from dataclasses import asdict

from .crawl import Channel, validate_start

REASONS = {200: "OK", 202: "Accepted", 400: "Bad Request", 401: "Unauthorized", 404: "Not Found", 409: "Conflict"}


def handle(method: str, path: str, token: str | None, body: bytes, expected: str | None, channel: Callable[[str], Channel], page_limit: int = 100) -> tuple[int, dict]:
    """(status, answer) of a request. Everything but /healthz needs the expected bearer token; none expected refuses all."""
    if path == "/healthz":
        return 200, {"ok": True}
    if not expected or token is None or not token.startswith("Bearer ") or not hmac.compare_digest(token.removeprefix("Bearer ").encode(), expected.encode()):
        return 401, {"error": "unauthorized"}
    if method == "POST" and path == "/v1/backfill/runs":
        try:
            asked = json.loads(body)
        except ValueError:
            return 400, {"error": "body must be JSON"}
        try:
            asked = validate_start(asked, page_limit)
        except (ValueError, AttributeError) as e:
            return 400, {"error": str(e)}
        fresh, run = channel(asked["channel_id"]).start(asked)
        return (202, {"run": asdict(run)}) if fresh else (409, {"error": "active_run_exists", "run": asdict(run)})
    if m := re.fullmatch(r"/v1/backfill/channels/([0-9]+)(?:/(resume)|/runs/([0-9a-f-]+))?", path):
        one = channel(m[1])
        if method == "POST" and m[2]:
            return 200, {"scheduled": one.resume()}
        if method == "GET" and not m[2]:
            run = one.status(m[3]) if m[3] else one.current()
            return (200, {"run": asdict(run)}) if run else (404, {"error": "run not found" if m[3] else "no run for channel"})
    return 404, {"error": "not found"}


def application(expected: str | None, channel: Callable[[str], Channel], page_limit: int = 100):
    def app(environ, start_response):
        size = int(environ.get("CONTENT_LENGTH") or 0)
        status, answer = handle(environ["REQUEST_METHOD"], environ["PATH_INFO"], environ.get("HTTP_AUTHORIZATION"), environ["wsgi.input"].read(size) if size else b"", expected, channel, page_limit)
        start_response(f"{status} {REASONS[status]}", [("Content-Type", "application/json; charset=utf-8")])
        return [json.dumps(answer).encode()]

    return app
