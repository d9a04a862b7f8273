"""Toxicity against a plain scan, and its learning from allowed labels alone."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from evidentia.llm import toxicity


def corpus():
    r = random.Random(9)
    words = ["".join(r.choice("abdenorst") for _ in range(r.randint(2, 7))) for _ in range(200)]
    bad = ["zorkface", "gnarfling", "plomp"]
    rows, labels = [], []
    for i in range(600):
        w = [r.choice(words) for _ in range(r.randint(5, 80))]
        toxic = int(r.random() < 0.3)
        if toxic:
            for _ in range(r.randint(1, 4)):
                b = r.choice(bad)
                w.insert(r.randrange(len(w)), r.choice([b, b.upper() + "!", b.replace("o", "0"), b.replace("a", "а"), b + "s"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    rows += [(1000, None), (1001, ""), (1002, "plomp"), (1002, "plomp"), (None, "zorkface"), (1003, "fine words " * 50_000 + "gnarfling"), (1004, "x" * 300_000)]
    return rows, labels


def plain(text, weights, exceptions):
    """Weight of a text by trying every entry at every place."""
    t = toxicity.Folds()
    f = toxicity.fold(text, t)
    spans = [(a, a + len(p) - 1) for e in exceptions for p in [toxicity.fold(e, t)] for a in range(len(f)) if f.startswith(p, a)]
    total = 0.0
    for a in range(len(f)):
        w = max((w for e, w in weights.items() if f.startswith(e, a)), default=0)
        if not any(x <= a < y for x, y in spans):
            total += w
    return total, len(f)


def test_scores_are_those_of_a_plain_scan(spark):
    rows, labels = corpus()
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights, curve = toxicity.learn(d, lab)
    assert {w.strip() for w in weights} & {"zorkface", "zorkf", "zork", "zorkfa"} and not any("fine" in w for w in weights)
    got = toxicity.score(d, lab).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.score, r.predicted, r.held_out))
    for i, text in rows:
        if len(text or "") < 10_000:
            z = float(np.dot(curve, toxicity.shape(*plain(text or "", weights, toxicity.EXCEPTIONS))))
            ((score, predicted, held),) = by[i]
            assert abs(score - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) < 1e-12 and predicted == (score >= 0.5) and held == (zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0)
    truth = {i: y for i, _, y in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(a == b for a, b in held) > 0.95 * len(held)


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus()
    d = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    one, two = (toxicity.score(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).where(F.col("doc_id").isNotNull()).orderBy("doc_id").collect() for x in (labels, flipped))
    assert one == two


def test_exceptions():
    auto = toxicity.automaton({" trash ": 2.0})
    f = lambda t: toxicity.matched(toxicity.fold(t, toxicity.Folds()), auto)
    assert f("a trash can") == 0 and f("trash") == 2 and f("trash cans") == 2 and f("TR4SH, trash bin") == 2
    assert toxicity.matched(toxicity.fold("any", toxicity.Folds()), toxicity.automaton({}, ())) == 0
