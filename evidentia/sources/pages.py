"""Pages of messages over HTTP: a client, and a streaming source whose offset is the cursor."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..plans.crawl import Response, advance, message_ids, parse_headers


class PageClient:
    """Asks for a channel's messages, newest first. Every status is an answer; only a failed transport raises."""

    def __init__(self, base: str, token: str, agent: str = "evidentia", timeout: float = 30.0):
        self.base, self.timeout = base.rstrip("/"), timeout
        self.headers = {"Authorization": f"Bot {token}", "User-Agent": agent, "Accept": "application/json"}

    def fetch(self, channel_id: str, before: str | None, limit: int) -> Response:
        asked = urllib.parse.urlencode({"limit": limit} | ({"before": before} if before is not None else {}))
        request = urllib.request.Request(f"{self.base}/channels/{channel_id}/messages?{asked}", headers=self.headers)
        started = time.time_ns() // 1_000_000
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                status, headers, body = r.status, r.headers, r.read()
        except urllib.error.HTTPError as e:
            status, headers, body = e.code, e.headers, e.read()
        return Response(status, parse_headers(headers), body, started, time.time_ns() // 1_000_000)


class PageReader(SimpleDataSourceStreamReader):
    def __init__(self, client: PageClient, channel_id: str, limit: int, before: str | None, after: str | None):
        self.client, self.channel_id, self.limit, self.before, self.after = client, channel_id, limit, before, after

    def initialOffset(self) -> dict:
        return {"before": self.before, "done": False}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """The page at a cursor. Another status than success fails the batch; the query starts again from its cursor."""
        if start["done"]:
            return iter(()), start
        r = self.client.fetch(self.channel_id, start["before"], self.limit)
        if r.status != 200:
            raise RuntimeError(f"status {r.status}")
        low, done = advance(message_ids(r.body), self.limit, self.after)
        return iter([(start["before"], r.body.decode(), r.started_ms, r.done_ms)]), {"before": start["before"] if low is None else low, "done": done}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        out, at = [], start
        while at["before"] != end["before"] or at["done"] != end["done"]:
            rows, at = self.read(at)
            out += rows
            if at["done"]:
                break
        return iter(out)


class PagedSource(DataSource):
    """Format 'pages': options url, token, channel, limit, before, after. A row is a page: (before, payload, started_ms,
    done_ms)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "before string, payload string, started_ms long, done_ms long"

    def simpleStreamReader(self, schema) -> PageReader:
        o = self.options
        return PageReader(PageClient(o["url"], o.get("token", "")), o["channel"], int(o.get("limit", "100")), o.get("before"), o.get("after"))
