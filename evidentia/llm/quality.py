"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Each byte has a
learned embedding; learned filters slide over the chunk with a stride, go through a ramp and are
max-pooled over the chunk. The chunks' pools are combined into one probability: their mean and
their maximum over the whole document feed a logistic unit. Embedding, filters and unit are trained
together by Adam on a labelled sample of at most `most` rows (default 3000) and `parts` chunks of
each (16, evenly spread); these bounds hold for training alone. Scoring reads every byte, a bounded
number of chunks at a time.

Defined cases: null and empty texts are one chunk of blanks. Without labels of both classes every
row scores 1.0 (nothing is rejected). Null ids come back, and count as '' in the split. Repeated
rows score alike. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled, remainder

CHUNK, STEP = 512, 448
EMB, WIDTH, STRIDE, FILTERS = 4, 12, 2, 24


def chunks(raw: bytes, first: int = 0, most: int | None = None) -> np.ndarray:
    """Overlapping chunks (n, CHUNK) of the bytes, the last one filled with blanks."""
    n = max(1, -(-(len(raw) - (CHUNK - STEP)) // STEP))
    last = n if most is None else min(n, first + most)
    part = raw[first * STEP : (last - 1) * STEP + CHUNK]
    part = np.frombuffer(part.ljust((last - first - 1) * STEP + CHUNK, b" "), np.uint8)
    return np.lib.stride_tricks.as_strided(part, (last - first, CHUNK), (STEP, 1))


def n_chunks(size: int) -> int:
    return max(1, -(-(size - (CHUNK - STEP)) // STEP))


def init(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {"emb": r.normal(0, 0.5, (256, EMB)), "w": r.normal(0, (2 / (WIDTH * EMB)) ** 0.5, (WIDTH * EMB, FILTERS)), "b": np.zeros(FILTERS), "out": r.normal(0, 0.1, 2 * FILTERS), "bias": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def windows(x: np.ndarray, emb: np.ndarray) -> np.ndarray:
    """(n, positions, WIDTH * EMB) view over the embedded bytes."""
    e = np.ascontiguousarray(emb[x])
    s = e.strides
    return np.lib.stride_tricks.as_strided(e, (len(x), (CHUNK - WIDTH) // STRIDE + 1, WIDTH * EMB), (s[0], s[1] * STRIDE, s[2]))


def pool(x: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray | None]:
    """Max-pooled filters of each chunk."""
    v = windows(x, p["emb"])
    h = v.reshape(-1, WIDTH * EMB) @ p["w"]
    return np.maximum(h.reshape(len(x), -1, FILTERS).max(axis=1) + p["b"], 0)


def probability(raw: bytes, p: dict, at_once: int = 256) -> float:
    """Of one document; at_once chunks are in memory."""
    total, top, n = np.zeros(FILTERS, np.float64), np.zeros(FILTERS, np.float32), n_chunks(len(raw))
    for k in range(0, n, at_once):
        h = pool(chunks(raw, k, at_once), p)
        total += h.sum(axis=0)
        top = np.maximum(top, h.max(axis=0))
    return float(squash(np.concatenate([total / n, top]) @ p["out"] + p["bias"][0]))


def squash(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def many(raws: list[bytes], p: dict, at_once: int = 256) -> list[float]:
    """Like probability for each text, with the chunks of short texts pooled together."""
    out, held, size = [0.0] * len(raws), [], 0

    def flush():
        h = pool(np.concatenate([chunks(raws[i]) for i in held]), p)
        starts = np.cumsum([0, *(n_chunks(len(raws[i])) for i in held)])
        mean = np.add.reduceat(h.astype(np.float64), starts[:-1]) / np.diff(starts)[:, None]
        z = np.hstack([mean, np.maximum.reduceat(h, starts[:-1])]) @ p["out"] + p["bias"][0]
        for i, s in zip(held, squash(z), strict=True):
            out[i] = float(s)

    for i, raw in enumerate(raws):
        n = n_chunks(len(raw))
        if n > at_once:
            out[i] = probability(raw, p, at_once)
            continue
        if held and size + n > at_once:
            flush()
            held, size = [], 0
        held.append(i)
        size += n
    if held:
        flush()
    return out


def train(raws: list[bytes], y: np.ndarray, parts: int = 16, epochs: int = 10, batch: int = 32, rate: float = 0.01, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the cross entropy; the gradient of a pool goes to the window that won it."""
    p, r = init(seed), np.random.default_rng(seed)
    spread = []
    for raw in raws:
        n = n_chunks(len(raw))
        spread.append(np.concatenate([chunks(raw, int(k), 1) for k in np.unique(np.linspace(0, n - 1, min(n, parts)).astype(int))]))
    m1, m2, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    p["bias"][:] = np.log(y.mean() / (1 - y.mean()))
    for epoch in range(epochs):
        order = r.permutation(len(raws))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x, sizes = np.concatenate([spread[i] for i in rows]), np.array([len(spread[i]) for i in rows])
            starts, doc = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(rows)), sizes)
            v = windows(x, p["emb"])
            h = (v.reshape(-1, WIDTH * EMB) @ p["w"]).reshape(len(x), -1, FILTERS)
            won = h.argmax(axis=1)
            a = np.take_along_axis(h, won[:, None], 1)[:, 0] + p["b"]
            act = np.maximum(a, 0)
            mean, top = np.add.reduceat(act, starts) / sizes[:, None], np.maximum.reduceat(act, starts)
            f = np.hstack([mean, top])
            d = (squash(f @ p["out"] + p["bias"][0]) - y[rows]).astype(np.float32) / len(rows)
            g = {"out": f.T @ d + 1e-4 * p["out"], "bias": np.array([d.sum()], np.float32)}
            df = d[:, None] * p["out"][None]
            dact = (df[:, :FILTERS] / sizes[:, None])[doc] + df[:, FILTERS:][doc] * (act == top[doc])
            dact *= a > 0
            at_byte = won[:, :, None] * STRIDE + np.arange(WIDTH)  # chunk, filter, place
            bytes_ = np.take_along_axis(x[:, None, :].repeat(FILTERS, 1), at_byte, 2)
            e = p["emb"][bytes_].reshape(len(x), FILTERS, WIDTH * EMB)
            g["w"] = np.einsum("cf,cfk->kf", dact, e)
            g["b"] = dact.sum(axis=0)
            de = (dact[:, :, None] * p["w"].T[None]).reshape(-1, EMB)
            g["emb"] = np.stack([np.bincount(bytes_.ravel(), de[:, k], 256) for k in range(EMB)], axis=1).astype(np.float32)
            t += 1
            step = rate * (0.5 * (1 + np.cos(np.pi * epoch / epochs)))
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] = (p[k] - step * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return p


def learn(docs: DataFrame, labels: DataFrame, most: int = 3000, by: int = 4, held: int = 2, parts: int = 16) -> dict[str, np.ndarray] | None:
    """Network from a labelled sample; at most parts chunks a row, evenly spread, come to the driver."""

    def each(batches):
        for b in batches:
            got = []
            for text in b.column(1).to_pylist():
                raw = text.encode()
                n = n_chunks(len(raw))
                if n > parts:  # the chunks that training would take, end to end
                    raw = b"".join(raw[int(k) * STEP : int(k) * STEP + STEP] for k in np.linspace(0, n - 1, parts).astype(int))
                got.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(got, pa.binary())], ["doc_id", "y", "raw"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = labelled(docs, labels, "quality", by, held, most).select("doc_id", "text", "y").mapInArrow(each, f"doc_id {kind}, y int, raw binary").orderBy("doc_id", "raw").collect()
    y = np.array([r.y for r in rows], np.float32)
    return train([bytes(r.raw) for r in rows], y, parts) if len(set(y.tolist())) == 2 else None


def scorer(net: dict | None):
    """Function from a list of texts to their probabilities."""
    return (lambda texts: [1.0] * len(texts)) if net is None else (lambda texts: many([(t or "").encode() for t in texts], net))


def score(docs: DataFrame, labels: DataFrame, most: int = 3000, by: int = 4, held: int = 2, least: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    net = learn(docs, labels, most, by, held)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        judge = scorer(net)
        for b in batches:
            for at in range(0, len(b), 200):
                part = b.slice(at, 200)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(judge(part.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    got = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(each, f"doc_id {kind}, score double")
    return got.select("doc_id", (remainder("doc_id", by) == held).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = 3000, by: int = 4, held: int = 2, least: float = 0.7) -> DataFrame:
    """The rows of docs, with all their columns, that score at least `least`."""
    net = learn(docs, labels, most, by, held)
    schema = docs.schema
    at = docs.columns.index("text")

    def each(batches):
        judge = scorer(net)
        for b in batches:
            for k in range(0, len(b), 200):
                part = b.slice(k, 200)
                yield part.filter(pa.array([s >= least for s in judge(part.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(each, schema)
