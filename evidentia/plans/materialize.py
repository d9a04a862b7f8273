"""Resumable rebuild of the canonical table from the archive.

A clean rebuild is one lazy plan (`rebuild`). `run` does the same in chunks whose every decision is derived
again from the control store, so it can stop and resume anywhere: the manifest is fixed once, a chunk's candidates are
written before its checkpoint, all commit batches are written by one job before the first commit, and commits are
recognised by the files that the table references."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import UUID7, staging_path
from ..operators import equivalence as E
from ..operators import projection as P
from ..schemas import CANONICAL, PROJECTION_VERSION
from ..scratch import cut
from ..sources import archive
from ..sources.control import ControlStore


def rebuild(spark: SparkSession, root: str, prefix: str = archive.BACKFILL, start=None, end=None) -> DataFrame:
    """The canonical table from the whole archive; from the evidence of a time range where one is given."""
    e = archive.read(spark, root, prefix).drop("key", "uploaded_at")
    if start is not None or end is not None:
        e = P.between(e, start or datetime(1970, 1, 1, tzinfo=UTC), end or datetime(9999, 12, 31, tzinfo=UTC))
    return P.project(e)


class ArchiveReader(Protocol):
    """What a run needs of an archive."""

    def listing(self) -> DataFrame: ...  # (key, uploaded_at)

    def envelopes(self, keys: Sequence[str]) -> DataFrame: ...


class TableWriter(Protocol):
    """What a run needs of a catalog."""

    def ensure_namespace(self) -> None: ...

    def ensure_table(self, name: str) -> str: ...

    def location(self, name: str) -> str: ...

    def commit(self, name: str, paths: Sequence[str]) -> str: ...


class SparkArchive:
    """The archive under a root."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = archive.BACKFILL):
        self.spark, self.root, self.prefix = spark, root, prefix

    def listing(self) -> DataFrame:
        return archive.listing(self.spark, self.root, self.prefix)

    def envelopes(self, keys: Sequence[str]) -> DataFrame:
        return archive.read_keys(self.spark, keys).drop("key", "uploaded_at")


@dataclass
class Config:
    run_id: str
    table: str = "message"
    chunk: int = 500
    batch: int = 5000
    concurrency: int = 8
    max_units: int = 0  # 0: no limit
    version: str = PROJECTION_VERSION
    fault: Callable[[str], None] = lambda point: None  # tests raise at 'after_candidates', 'after_stage', 'after_commit'


class Units:
    """How many units of new work an invocation may still do."""

    def __init__(self, most: int):
        self.left, self.lock, self.stopped = most if most > 0 else -1, threading.Lock(), False

    def take(self) -> bool:
        with self.lock:
            if self.left == 0:
                self.stopped = True
                return False
            self.left -= self.left > 0
            return True


def fix_manifest(control: ControlStore, listing: DataFrame, cfg: Config, cutoff: datetime) -> dict:
    """Objects uploaded at the cutoff or before, in chunks of sorted keys. The keys are a table beside the control
    object, so they never pass the driver; the object is created once, and a later candidate is ignored. identity is
    a digest of the keys, by which the input can be shown to be unchanged."""
    key = f"runs/{cfg.run_id}/manifest.json"
    if (fixed := control.get(key)) is not None:
        return fixed
    table = control.store.uri(f"runs/{cfg.run_id}/manifest-{uuid.uuid4().hex}")
    kept = listing.where(F.col("uploaded_at") <= F.lit(cutoff)).select("key")
    P.chunks(kept, "key", cfg.chunk).repartitionByRange("chunk", "key").sortWithinPartitions("chunk", "key").write.parquet(table)
    got = P.set_digest(listing.sparkSession.read.parquet(table), ids=F.col("key")).withColumn("n", F.ceil(F.col("members") / max(1, cfg.chunk))).first()
    control.put_if_absent(key, {"run_id": cfg.run_id, "cutoff": cutoff.isoformat(), "keys": table, "objects": got.members, "chunks": int(got.n), "identity": f"{int(got.total or 0):x}-{int(got.mixed or 0):x}"})
    return control.get(key)


def run(spark: SparkSession, control: ControlStore, catalog: TableWriter, reader: ArchiveReader, cfg: Config, cutoff: datetime | None = None) -> dict:
    """One invocation; returns the run's status."""
    if not re.match(UUID7, cfg.run_id):
        raise ValueError("run id must be a UUID of version 7")
    base, units = f"runs/{cfg.run_id}", Units(cfg.max_units)

    def status(phase: str, **more) -> dict:
        old = control.get(f"{base}/status.json") or {}
        now = datetime.now(UTC).isoformat()
        s = old | {"run_id": cfg.run_id, "phase": phase, "started_at": old.get("started_at", now), "updated_at": now, "failure": ""} | more
        control.put(f"{base}/status.json", s)
        return s

    phase = "extracting"
    try:
        fixed = fix_manifest(control, reader.listing(), cfg, cutoff or datetime.now(UTC))
        status(phase)
        extract(spark, control, reader, cfg, fixed, units)
        if units.stopped:
            return status(phase)
        phase = "committing"
        staged = stage(spark, control, catalog, cfg, fixed)
        status(phase, row_count=staged["rows"], commit_batch_count=len(staged["batches"]))
        commit(control, catalog, cfg, staged, units)
        return status(phase if units.stopped else "completed")
    except Exception as e:
        status(phase, failure=str(e)[:512])
        raise


def extract(spark: SparkSession, control: ControlStore, reader: ArchiveReader, cfg: Config, fixed: dict, units: Units) -> None:
    """Candidates and checkpoint of every chunk that has none, some chunks at a time."""
    base = f"runs/{cfg.run_id}"

    def one(i: int) -> None:
        keys = [r.key for r in spark.read.parquet(fixed["keys"]).where(F.col("chunk") == i).select("key").orderBy("key").collect()]  # a chunk's size
        envelopes = reader.envelopes(keys)
        path = control.store.uri(f"{base}/candidates/{i:05d}")
        P.project(envelopes, cfg.version).write.mode("overwrite").parquet(path)
        rows = spark.read.schema(CANONICAL).parquet(path)
        ident = P.identity(envelopes, ids=F.lower("observation_id")).first().identity  # a chunk's size
        cfg.fault("after_candidates")
        control.put_if_absent(f"{base}/extract/{i:05d}.json", {"chunk_index": i, "chunk_id": ident, "object_keys": len(keys), "row_count": rows.count(), "digest": E.digest(rows)})

    with ThreadPoolExecutor(max(1, cfg.concurrency)) as pool:
        todo = []
        for i in range(fixed["chunks"]):
            if control.get(f"{base}/extract/{i:05d}.json"):
                continue
            if not units.take():
                break
            todo.append(pool.submit(one, i))
        for t in todo:
            t.result()


def stage(spark: SparkSession, control: ControlStore, catalog: TableWriter, cfg: Config, fixed: dict) -> dict:
    """Reduces the candidates, ranks them once, and writes all commit batches by one job, each sorted and under the path
    that its identity names. Done once a run: a checkpoint lists the batches."""
    key = f"runs/{cfg.run_id}/staged.json"
    if (done := control.get(key)) is not None:
        return done
    paths = [control.store.uri(f"runs/{cfg.run_id}/candidates/{i:05d}") for i in range(fixed["chunks"])]
    batches = []
    if paths:
        catalog.ensure_namespace()
        catalog.ensure_table(cfg.table)
        rows = cut(P.in_order(P.best_known(spark.read.schema(CANONICAL).parquet(*paths))), "reduced")
        ranked = cut(rows.join(P.chunks(rows, "message_id", cfg.batch).withColumnRenamed("chunk", "batch"), "message_id"), "ranked")
        names = P.identity(ranked, "batch", ids=F.concat_ws("|", "message_id", "observation_id"))  # a batch's size
        folder = staging_path(catalog.location(cfg.table), cfg.run_id, "x").rsplit("/", 1)[0]
        out = ranked.join(names, "batch").withColumn("chunk", F.concat("identity", F.lit(".parquet")))
        out = out.repartition("chunk").sortWithinPartitions("chunk", "message_id")
        out.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in CANONICAL], "chunk").write.mode("overwrite").partitionBy("chunk").option("compression", "zstd").parquet(folder)
        counts = ranked.groupBy("batch").count().join(names, "batch").orderBy("batch").collect()  # one row a batch
        batches = [{"batch_index": int(r.batch), "chunk_id": r.identity, "staging_key": staging_path(catalog.location(cfg.table), cfg.run_id, r.identity), "row_count": r["count"]} for r in counts]
    control.put_if_absent(key, {"rows": sum(b["row_count"] for b in batches), "batches": batches})
    return control.get(key)


def commit(control: ControlStore, catalog: TableWriter, cfg: Config, staged: dict, units: Units) -> None:
    """Commits each staged batch that has no checkpoint; one that a crash left without is found in the table."""
    for b in staged["batches"]:
        key = f"runs/{cfg.run_id}/commit/{b['batch_index']:05d}.json"
        if (control.get(key) or {}).get("committed"):
            continue
        if not units.take():
            return
        cfg.fault("after_stage")
        got = catalog.commit(cfg.table, [b["staging_key"]])
        cfg.fault("after_commit")
        control.put_if_absent(key, b | {"committed": True, "result": got})
