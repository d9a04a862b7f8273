"""The pipeline's near-duplicates against brute force."""

import random

import corpus_pipeline
from evidentia.llm import simhash


def brute_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_stage_drops_all_copies_at_0_8(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    line, rows = [word() for _ in range(15)], []
    for g in range(40):
        w = [word() for _ in range(r.randint(30, 200))] + line * (g % 2)
        rows.append(" ".join(w))
        for _ in range(3):
            c = list(w)
            for at in r.sample(range(len(c)), r.randint(1, max(1, len(c) // 30))):
                c[at] = word()
            rows.append(" ".join(c).upper() if g % 3 == 0 else " ".join(c))
    rows += [rows[0], None, "", " ", "a b", "A  b", "a b c", "a b c d e", "a b c d e f"]
    sets, root = [brute_set(t) for t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = sorted(x.doc_id for x in corpus_pipeline.simhash_stage(spark, d, "").collect())
    assert got == sorted({find(i) for i in range(len(rows))})
    odd = spark.createDataFrame([(None, "x y"), (None, "x y"), (6, "z"), (5, "z")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_dissimilar(odd).collect()), key=str) == [(5, "z"), (None, "x y")]
    assert simhash.keep_dissimilar(d.limit(0)).count() == 0


def test_links_of_a_large_group_are_whole():
    import numpy as np

    r = np.random.default_rng(2)
    base = np.unique(r.integers(0, 1 << 62, 60)).astype(np.uint64)
    sets = [np.unique(np.concatenate([r.permutation(base)[: r.integers(44, 60)], r.integers(0, 1 << 62, r.integers(0, 8)).astype(np.uint64)])) for _ in range(120)]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = [find(i) for i in range(len(sets))]
    assert 1 < len(set(want)) < len(sets)
    for at_once in (1 << 22, 700):
        lab = np.arange(len(sets))
        i, j = simhash.exact_links(sets, 0.8, at_once)
        lab[i] = j
        assert lab.tolist() == want
    few = simhash.exact_links(sets[:12], 0.8)
    assert all(find(a) == find(b) for a, b in zip(*few, strict=True))


def test_blocks_and_clusters_in_tiles(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, rows = [word() for _ in range(60)], []
    for _ in range(60):
        c = list(base)
        for at in r.sample(range(60), r.randint(0, 2)):
            c[at] = word()
        rows.append(" ".join(c))
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    whole = {(x.id, x.component) for x in simhash.similar_classes(d).collect()}
    cut = {(x.id, x.component) for x in simhash.similar_classes(d, tile=20, members=700).collect()}
    assert whole == cut and 1 < len({c for _, c in whole}) < 40


def test_kept_row_is_of_its_class(spark):
    a, b = "a b c d e f g h", "q r s t u v w x"
    d = spark.createDataFrame([(3, b, "x"), (5, a, "y"), (5, b, "z")], "doc_id long, text string, t string")
    for keep in (simhash.keep_one, simhash.keep_dissimilar):
        assert sorted((r.doc_id, r.text) for r in keep(d).collect()) == [(3, b), (5, a)]
