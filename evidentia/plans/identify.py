"""Leases for opening gateway sessions: one for each concurrency bucket in a window, within the daily budget."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..sources.control import ControlStore

WINDOW_MS, LEASE_MS = 5000, 30_000


@dataclass
class Coordinator:
    """total, remaining, reset_at and max_concurrency are what the service last said; `limits` sets them anew.
    leases: request id to its lease."""

    total: int = 0
    remaining: int = 0
    reset_at: int = 0
    max_concurrency: int = 1
    stale: bool = True
    leases: dict[str, dict] = field(default_factory=dict)

    def limits(self, total: int, remaining: int, reset_after_ms: int, max_concurrency: int, now: int) -> None:
        self.total, self.remaining, self.reset_at, self.max_concurrency, self.stale = total, remaining, now + reset_after_ms, max(1, max_concurrency), False

    def bucket(self, shard: int) -> int:
        return shard % self.max_concurrency

    def acquire(self, request_id: str, instance: str, shard: int, now: int) -> tuple[bool, str | None, int]:
        """(granted, reason, retry after ms). A request that is asked again gets its lease again and costs nothing;
        a lease that was never used ends and gives its place and its budget back."""
        for k, x in list(self.leases.items()):
            if x["state"] == "granted" and now >= x["expires_at"]:
                self.remaining += 1
                del self.leases[k]
            elif x["state"] != "granted" and now >= x["at"] + WINDOW_MS and k != request_id:
                del self.leases[k]
        if request_id in self.leases:
            return True, None, 0
        if self.stale or now >= self.reset_at:
            return False, "limits_unknown", 1000
        if self.remaining <= 0:
            return False, "daily_budget", max(1, self.reset_at - now)
        same = [x["at"] for x in self.leases.values() if x["bucket"] == self.bucket(shard) and now < x["at"] + WINDOW_MS]
        if same:
            return False, "bucket_window", max(same) + WINDOW_MS - now
        self.remaining -= 1
        self.leases[request_id] = {"instance": instance, "shard": shard, "bucket": self.bucket(shard), "at": now, "expires_at": now + LEASE_MS, "state": "granted"}
        return True, None, 0

    def sent(self, request_id: str) -> None:
        """The session was opened with the lease."""
        if request_id in self.leases:
            self.leases[request_id]["state"] = "sent"

    def refused(self) -> None:
        """The service contradicts what is known: no lease until `limits` is called again."""
        self.stale = True

    def save(self, control: ControlStore, key: str = "crawl/identify.json") -> None:
        control.put(key, vars(self))

    @classmethod
    def load(cls, control: ControlStore, key: str = "crawl/identify.json") -> Coordinator:
        return cls(**(control.get(key) or {}))
