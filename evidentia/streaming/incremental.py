"""Structured Streaming: incremental projection, gateway frames, and the request budget as keyed state.

Late evidence is just another observation: the state keeps each message's winner and no watermark drops rows.
The incremental path is for latency; a full rebuild remains the authority and gives the same table."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import staging_path
from ..operators import projection as P
from ..schemas import ENVELOPE
from ..sources.catalog import Catalog


def read_archive(spark: SparkSession, root: str, per_trigger: int = 1000) -> DataFrame:
    """Envelopes as files arrive."""
    raw = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").option("maxFilesPerTrigger", per_trigger).load(root)
    return raw.select(F.from_json("value", ENVELOPE, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def current(envelopes: DataFrame) -> DataFrame:
    """Best-known state; write it in complete mode. Duplicates of an observation change nothing."""
    return P.in_order(P.best_known(P.snapshots(P.validated(envelopes))))


def append_winners(catalog: Catalog, name: str, run: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that adds a batch's winners to a table, under the batch's number: a repeated batch is
    known by its files, and work follows the batch, not the table. Read the table by `state`."""

    def each(batch: DataFrame, n: int) -> None:
        catalog.ensure_table(name)
        path = staging_path(catalog.location(name), run, f"batch-{n:010d}")
        if path not in catalog.state(name)[1]:
            catalog.commit(name, [catalog.stage(name, P.project(batch), run, f"batch-{n:010d}")])

    return each


def state(catalog: Catalog, name: str) -> DataFrame:
    """The winners of all batches."""
    return P.reduce(catalog.scan(name))


def compact(catalog: Catalog, name: str, run: str, chunk: str) -> str:
    """Puts the table's winners in one place of their files'; no batch may be added meanwhile."""
    return catalog.replace(name, [catalog.stage(name, state(catalog, name), run, chunk)])


#: A frame of the gateway: opcode, event name, sequence and data, as received.
FRAME = "op int, t string, s long, d string"
#: Events about passing behaviour, which aren't kept. Fixed values.
TRANSIENT = ("PRESENCE_UPDATE", "TYPING_START", "VOICE_STATE_UPDATE")


def dispatches(frames: DataFrame) -> DataFrame:
    """frames (observation_id, observed_at, frame, instance_id, session_id, shard, intents) to gateway envelopes, one for
    each dispatch (opcode 0). payload is the frame's text, unchanged; control and transient frames are left out."""
    f = frames.withColumn("f", F.from_json("frame", FRAME)).where((F.col("f.op") == 0) & ~F.coalesce(F.col("f.t").isin(*TRANSIENT), F.lit(False)))
    return f.select(
        F.lit("v1").alias("envelope_version"), F.lower("observation_id").alias("observation_id"), F.lit("gateway").alias("source_kind"), "observed_at", F.col("frame").alias("payload"),
        F.struct("instance_id", "session_id", "shard", F.col("f.s").alias("sequence"), F.col("f.t").alias("event"), "intents").alias("gateway"),
    )


def granted(ms: np.ndarray, slots: deque, ceiling: int, window_ms: int) -> np.ndarray:
    """Which of the requests, in order of time, get a slot. slots: times of the last grants, at most `ceiling`."""
    out = np.zeros(len(ms), bool)
    for i, now in enumerate(ms.tolist()):
        if len(slots) < ceiling or slots[0] <= now - window_ms:
            if len(slots) == ceiling:
                slots.popleft()
            slots.append(now)
            out[i] = True
    return out


def grants(requests: DataFrame, ceiling: int, window_ms: int) -> DataFrame:
    """requests (app, id, ms) in order of time for each app -> (app, id, ms, granted). A refused request takes no
    slot, so this is a fold over keyed state and not a window."""

    def each(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        slots = deque(state.get[0] if state.exists else [])
        rows = pd.concat(list(batches)).sort_values(["ms", "id"])
        got = granted(rows["ms"].to_numpy(), slots, ceiling, window_ms)
        state.update((list(slots),))
        yield pd.DataFrame({"app": key[0], "id": rows["id"], "ms": rows["ms"], "granted": got})

    return requests.groupBy("app").applyInPandasWithState(each, "app string, id long, ms long, granted boolean", "slots array<long>", "append", GroupStateTimeout.NoTimeout)


def replay(requests: DataFrame, key: str, ceiling: int, window_ms: int) -> DataFrame:
    """The same fold over a batch: (key, id, ms, granted). A key's requests are streamed in order of time, and only its
    slots are held, so its history needn't fit in memory."""

    def each(batches):
        last, slots = object(), deque()
        for b in batches:
            keys, ms = b.column(0), b.column(2).to_numpy()
            codes = keys.dictionary_encode()
            code = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
            out = []
            for a, z in zip(starts, [*starts[1:], len(code)], strict=True):
                if (now := keys[int(a)].as_py()) != last:
                    last, slots = now, deque()
                out.append(granted(ms[a:z], slots, ceiling, window_ms))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate([np.zeros(0, bool), *out]))], [*b.schema.names, "granted"])

    kind = requests.schema[key].dataType.simpleString()
    rows = requests.select(key, "id", "ms").repartition(key).sortWithinPartitions(key, "ms", "id")
    return rows.mapInArrow(each, f"{key} {kind}, id long, ms long, granted boolean")


__all__ = ["append_winners", "compact", "current", "dispatches", "granted", "grants", "read_archive", "replay", "state"]
