"""Small durable JSON objects of a run, in a store."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from .store import Store, store_at


class ControlStore:
    def __init__(self, root: str | Store, spark: SparkSession | None = None):
        self.store = store_at(root, spark) if isinstance(root, str) else root
        self.root = self.store.root

    def put_if_absent(self, key: str, value) -> bool:
        """True if this call made the object."""
        return self.store.put_if_absent(key, json.dumps(value).encode())

    def put(self, key: str, value) -> None:
        self.store.put(key, json.dumps(value).encode())

    def get(self, key: str):
        raw = self.store.get(key)
        return None if raw is None else json.loads(raw)

    def list(self, prefix: str) -> list[str]:
        return [k for k, _ in self.store.list(prefix) if k.endswith(".json")]
