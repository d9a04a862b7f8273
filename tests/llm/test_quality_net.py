"""The quality network against a plain convolution and a numeric gradient."""

import math
import random

import numpy as np

from evidentia.llm import quality as Q


def plain(raw, p):
    """One document by loops over chunks, filters and places."""
    pools = []
    for k in range(max(1, math.ceil((len(raw) - (Q.CHUNK - Q.STEP)) / Q.STEP))):
        x = raw[k * Q.STEP : k * Q.STEP + Q.CHUNK].ljust(Q.CHUNK, b" ")
        e = [p["emb"][b].astype(float) for b in x]
        row = []
        for f in range(Q.FILTERS):
            best = max(sum(float(e[at + w] @ p["w"][w * Q.EMB : (w + 1) * Q.EMB, f]) for w in range(Q.WIDTH)) for at in range(0, Q.CHUNK - Q.WIDTH + 1, Q.STRIDE))
            row.append(max(0.0, best + float(p["b"][f])))
        pools.append(row)
    a = np.array(pools)
    return 1 / (1 + math.exp(-float(np.concatenate([a.mean(axis=0), a.max(axis=0)]) @ p["out"] + p["bias"][0])))


def test_convolution_over_the_whole_document():
    p, r = Q.init(3), random.Random(1)
    p["out"] = np.random.default_rng(5).normal(0, 0.3, 2 * Q.FILTERS).astype(np.float32)
    for n in (0, 1, 511, 512, 513, 960, 1300):
        raw = bytes(r.randrange(256) for _ in range(n))
        assert abs(Q.probability(raw, p) - plain(raw, p)) < 1e-5 and abs(Q.many([raw, b"x"], p)[0] - plain(raw, p)) < 1e-5
        assert sum(len(c) for c in Q.chunks(raw)) >= n
    long = bytes(r.randrange(256) for _ in range(300_000))
    assert abs(Q.probability(long, p, 7) - Q.probability(long, p, 256)) < 1e-6  # chunks at once don't matter
    changed = long[:-40] + bytes(40)  # the end of a long text counts
    assert not np.array_equal(Q.pool(Q.chunks(long)[-1:], p), Q.pool(Q.chunks(changed)[-1:], p))


def test_gradient_is_the_numeric_one(monkeypatch):
    """One step of training moves against the slope that differences show."""
    r = random.Random(2)
    raws, y = [bytes(r.randrange(256) for _ in range(r.randint(1, 900))) for _ in range(8)], np.array([0, 1, 1, 0, 1, 0, 0, 1], np.float32)
    start = Q.init(7)
    start["bias"][:] = np.log(y.mean() / (1 - y.mean()))

    def loss(p):
        total = 0.0
        for raw, t in zip(raws, y, strict=True):
            h = Q.pool(Q.chunks(raw), p).astype(float)
            q = 1 / (1 + math.exp(-float(np.concatenate([h.mean(axis=0), h.max(axis=0)]) @ p["out"].astype(float) + float(p["bias"][0]))))
            total -= t * math.log(q) + (1 - t) * math.log(1 - q)
        return total / len(raws) + 0.5e-4 * float((p["out"].astype(float) ** 2).sum())

    # Adam's first step is rate * sign(gradient): compare signs with differences
    after = Q.train(raws, y, epochs=1, batch=8, rate=1e-3, seed=7)
    tried = agreed = 0
    pick = np.random.default_rng(4)
    for k in ("w", "b", "out", "emb"):
        for at in pick.integers(0, start[k].size, 60):
            move = float(after[k].ravel()[at] - start[k].ravel()[at])
            up, down = ({n: v.astype(np.float64).copy() for n, v in start.items()} for _ in range(2))
            up[k].ravel()[at] += 1e-5
            down[k].ravel()[at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-5:
                tried += 1
                agreed += move * slope < 0
    assert tried > 60 and agreed >= 0.97 * tried


def test_ties_and_repeats(spark):
    rows = [(1, "same"), (2, "same"), (2, "same"), (None, "same"), (3, None), (4, "")]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    lab = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = Q.score(d, lab).collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and {r.score for r in got if r.doc_id == 3} == {r.score for r in got if r.doc_id == 4}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert Q.keep_good(d, lab).columns == d.columns
