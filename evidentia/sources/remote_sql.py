"""A client of a SQL engine behind HTTP."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from dataclasses import dataclass

from ..functions.scalars import cut_text


@dataclass(frozen=True)
class Answer:
    rows: list[dict]
    raw: bytes
    status: int
    elapsed_s: float


def rows_of(raw: bytes) -> list[dict]:
    """Rows of an answer: an array, an object with rows or results, or a wrapper with such a result; its errors raise."""
    text = raw.decode("utf-8", "replace")
    try:
        got = json.loads(raw)
    except ValueError as e:
        raise ValueError(f"answer of unknown shape: {cut_text(text)}") from e
    if isinstance(got, dict) and got.get("result") is not None:
        if got.get("errors") and not got.get("success"):
            raise RuntimeError(f"query failed: {cut_text(text)}")
        got = got["result"]
    if isinstance(got, dict):
        got = got["rows"] if got.get("rows") is not None else got.get("results") or []
    if not isinstance(got, list) or not all(isinstance(r, dict) for r in got):
        raise ValueError(f"answer of unknown shape: {cut_text(text)}")
    return got


class RemoteSql:
    """url: where queries are posted."""

    def __init__(self, url: str, token: str, timeout: float = 120.0):
        self.url, self.token, self.timeout = url, token, timeout

    def query(self, sql: str) -> Answer:
        request = urllib.request.Request(self.url, json.dumps({"query": sql}).encode(), {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"}, method="POST")
        began = time.monotonic()
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                raw, status = r.read(), r.status
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"status {e.code}: {cut_text(e.read().decode('utf-8', 'replace'))}") from e
        return Answer(rows_of(raw), raw, status, time.monotonic() - began)
