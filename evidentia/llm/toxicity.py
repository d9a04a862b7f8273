"""Toxicity: a weighted lexicon matched by Aho-Corasick, normalised by length.

Texts are folded first: compatibility forms and combining marks, lower case, homoglyphs of Latin
letters, digits and signs that stand for letters; all other signs become blanks. Lexicon entries are
whole words (' word ') and word beginnings (' begin'), weighted by their smoothed log odds between
toxic and clean labelled texts; nothing else enters the lexicon. A match inside an
exception phrase doesn't count. The matched weight, plain and by length, goes through a logistic
curve that is fitted on labelled rows that the lexicon wasn't learned from.

The labelled sample has at most `most` rows (default 8000), a documented bound; every row of the
corpus is scored over its whole text.

Defined cases: null and empty texts score as a text without matches. Without labels of both classes
the lexicon is empty and every row scores alike, near the share of toxic labels. Null ids come back, and count as '' in the
split. Repeated rows score alike. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled, logistic, remainder

EXCEPTIONS = ("trash can", "trash bin", "trash collection", "class clown", "clown fish", "pathetic fallacy", "pond scum", "sore loser")
#: signs that stand for letters
LEET = dict(zip("013457@$", "oieastas", strict=True))
#: Cyrillic and Greek letters that look like Latin ones
ALIKE = dict(zip("асеорхуіјѕһԁԛԝвкмнтαβεικνορτυχ", "aceopxyijshdqwbkmhtabeiknoptux", strict=True))
BEGINS = (4, 5, 6)


class Folds(dict):
    """Table for str.translate, filled as characters are met."""

    def __missing__(self, code: int):
        c = chr(code)
        if c in LEET or c in ALIKE:
            to = LEET.get(c) or ALIKE[c]
        else:
            to = None if unicodedata.combining(c) else c if c.isalnum() else " "
        self[code] = to
        return to


def fold(text: str, table: Folds) -> str:
    return f" {(text.lower() if text.isascii() else unicodedata.normalize('NFKD', text).lower()).translate(table)} "


def entries(folded: str) -> set[str]:
    """Lexicon entries that a text could give."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in BEGINS if len(w) >= n}


def weigh(counts: list[tuple[str, int, int]], n1: int, n0: int, least: float = 18.0) -> dict[str, float]:
    """Weights of the entries that mark toxic texts; least is the log-likelihood ratio asked for."""
    got = {}
    for entry, a, b in counts:
        odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
        p, ll = n1 / (n1 + n0), 0.0
        for k, q in ((a, p), (b, 1 - p)):
            if k:
                ll += 2 * k * math.log(k / ((a + b) * q))
        if odds > 2 and ll >= least:
            got[entry] = (odds, a)
    # a longer entry says nothing new if a beginning of it weighs as much
    return {e: w for e, (w, _) in got.items() if not any((x := got.get(e[: n + 1])) and len(e) > n + 1 and x[0] >= w - 0.5 for n in BEGINS)}


def automaton(weights: dict[str, float], exceptions=EXCEPTIONS):
    auto, table = ahocorasick.Automaton(), Folds()
    auto.add_word("\0", (1, 0.0))  # in no folded text; an automaton without words can't be searched
    for entry, w in weights.items():
        auto.add_word(entry, (len(entry), w))
    for phrase in exceptions:
        entry = fold(phrase, table)
        auto.add_word(entry, (len(entry), -1.0))
    auto.make_automaton()
    return auto


def matched(folded: str, auto) -> float:
    """Sum over word starts of the heaviest entry there, without those inside exception phrases."""
    best: dict[int, float] = {}
    spans = []
    for end, (n, w) in auto.iter(folded):
        start = end - n + 1
        if w < 0:
            spans.append((start, end))
        elif w > best.get(start, 0):
            best[start] = w
    return sum(w for s, w in best.items() if not any(a <= s < b for a, b in spans))


def shape(total: float, size: int) -> list[float]:
    """Inputs of the curve: one, matched weight, matched weight by length in words (about six signs each)."""
    return [1.0, math.log1p(total), math.log1p(100 * total / (size / 6 + 30))]


def learn(docs: DataFrame, labels: DataFrame, most: int = 8000, by: int = 5, held: int = 0, exceptions=EXCEPTIONS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and curve from labelled rows."""
    sample = labelled(docs, labels, "toxic", by, held, most).withColumn("fit", remainder("doc_id", 1009) % 4 == 0)

    def count(batches):
        table, tally = Folds(), Counter()
        for b in batches:
            for text, y, fit in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if not fit:
                    tally.update((e, y) for e in entries(fold(text, table)))
        if tally:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in tally]), pa.array([k[1] for k in tally], pa.int32()), pa.array(list(tally.values()), pa.int64())], ["entry", "y", "n"])

    sizes = {r.y: r["count"] for r in sample.where("not fit").groupBy("y").count().collect()}
    bias = math.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5)) if sizes else -3.0
    if len(sizes) < 2:
        return {}, np.array([bias, 0.0, 0.0])
    counts = sample.select("text", "y", "fit").mapInArrow(count, "entry string, y int, n long").groupBy("entry").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    counts = counts.where((F.col("a") >= 3) & (F.col("a") * sizes[0] > 5 * F.col("b") * sizes[1])).collect()  # of the bounded sample
    weights = weigh([tuple(r) for r in counts], sizes[1], sizes[0])

    def measure(batches):
        auto, table = automaton(weights, exceptions), Folds()
        for b in batches:
            folded = [fold(t, table) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([matched(f, auto) for f in folded], pa.float64()), pa.array([len(f) for f in folded], pa.int64()), b.column(1)], ["total", "size", "y"])

    rows = sample.where("fit").select("text", "y").mapInArrow(measure, "total double, size long, y int").collect()  # a quarter of the sample
    x, y = np.array([shape(r.total, r["size"]) for r in rows]), np.array([float(r.y) for r in rows])
    if len(set(y)) < 2:
        return weights, np.array([-3.0, 1.5, 1.0])  # too few to fit a curve
    return weights, logistic(x, y, 0.05)


def score(docs: DataFrame, labels: DataFrame, most: int = 8000, by: int = 5, held: int = 0, exceptions=EXCEPTIONS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    weights, curve = learn(docs, labels, most, by, held, exceptions)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        auto, table = automaton(weights, exceptions), Folds()
        for b in batches:
            got = []
            for text in b.column(1):
                f = fold(text.as_py() or "", table)
                z = float(np.dot(curve, shape(matched(f, auto), len(f))))
                got.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    got = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(each, f"doc_id {kind}, score double")
    return got.select("doc_id", (remainder("doc_id", by) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
