"""Shared helpers: tables, files of the shared folder, words, connected components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut, shared_dir  # noqa: F401  (for the modules here)

#: A word is a run of characters other than the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_path(uri: str, mode: str):
    """A file of the shared folder, local or in any store that pyarrow reaches."""
    if uri.startswith(("file:", "/")):
        path = "/" + uri.removeprefix("file:").lstrip("/")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if mode == "rb":
        return store.open_input_file(path)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def lean(threshold: int = 1 << 20) -> None:
    """Tells the C library, where it is one that listens, to give large arrays back to the system when they are freed, so
    that a worker doesn't keep the memory of its largest batch."""
    import ctypes

    try:
        ctypes.CDLL(None).mallopt(-3, threshold)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):
        pass


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_in(c: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo by; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) by alternating large-star and small-star rounds
    (Kiveris et al., 2014). Returns (node, root), root the smallest node reached, for every
    node that has an edge to another one. Each round's edges are written to the shared folder."""

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = mark(e)
    for _ in range(most_rounds if state[0] else 0):
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        e = cut(small.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct(), "edges")
        before, state = state, mark(e)
        if before == state:
            break
    else:
        if state[0]:
            raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def labelled(docs: DataFrame, labels: DataFrame, label: str, by: int, held: int, most: int) -> DataFrame:
    """(doc_id, text, y): at most `most` labelled rows that aren't held out (crc32 of the id modulo `by`
    equal to `held`), those with the smallest hash of the id. The ids are few enough to be broadcast."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (remainder("doc_id", by) != held))
    ids = ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")


def logistic(x, y, ridge: float = 1.0, rounds: int = 30):
    """Weights of a logistic regression by Newton's method; x has a column of ones."""
    import numpy as np

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w
