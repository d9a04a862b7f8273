"""The corpus pipeline against plain loops, stage by stage."""

import hashlib
import random
import re

import corpus_pipeline
import pytest
from test_decontam import brute
from test_similar import brute_set

from evidentia.llm import quality, secrets
from evidentia.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7)))
    good = lambda: " ".join(word() for _ in range(r.randint(30, 90)))
    item = "If Anna buys 12 apples for 3 dollars, then how much does Anna pay for 12 apples in all?"
    rows, labels = [], []
    for i in range(160):
        bad = i % 4 == 0
        t = "#### $$$$ " * r.randint(5, 40) if bad else good()
        labels.append((i, 0 if bad else 1, 0))
        if i % 10 == 3:
            t += f" {item} " + good()
        if i % 7 == 2:
            t += f' token = "{"".join(r.choice("0123456789abcdef") for _ in range(40))}" ' + good()
        rows.append((i, t, "en", f"s{i % 5}" if i % 11 else None, len(t)))
    for i in range(160, 200):  # near copies
        w = rows[r.randrange(160)][1].split()
        w[r.randrange(len(w))] = word()
        rows.append((i, " ".join(w), "en", "s1", 0))
    rows += [rows[5], (None, rows[6][1], "en", "s0", 0), (None, good(), None, None, None), (300, None, None, "s2", None), (301, "", "en", "s2", 0), (302, "word " * 60_000, "en", "s3", 0), (5, rows[9][1] + " other", "en", "s1", 0)]
    return rows, labels, [(0, item), (1, None)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows, labels, items = corpus()
    spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, found string, key string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def size(text):
    return len(WORD.findall(text or ""))


def plain(spark, sf):
    """The same result by loops over lists."""
    rows, _, items = corpus()
    judge = quality.scorer(quality.learn(table(spark, sf, "documents"), table(spark, sf, "labels")))
    rows = [r for r, s in zip(rows, judge([r[1] for r in rows]), strict=True) if s >= 0.7]
    assert 0 < len(rows) < 207
    sets, root = [brute_set(r[1]) for r in rows], list(range(len(rows)))

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
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i])
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    leaks = {d for d, _ in brute([(r[0], r[1]) for r in rows], items)}
    rows = [r for r in rows if r[0] not in leaks]
    trees, find_all, prefix = secrets.fit(spark), re.compile(secrets.CANDIDATE, re.ASCII), re.compile(secrets.PREFIX, re.ASCII)
    d = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "i long, text string")
    bad = {r.i: {x.value for x in r.findings if x.secret} for r in secrets.scan(d, trees).collect()}

    def one(i):
        def swap(m):
            p = prefix.match(m[0])
            n = p.end() if p else 0
            return m[0][:n] + "[SECRET]" if m[0][n:] in bad[i] else m[0]

        return None if rows[i][1] is None else find_all.sub(swap, rows[i][1])

    rows = [(r[0], one(i), r[3]) for i, r in enumerate(rows)]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, left, target = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, float(sum(sizes.values())), {}
    while True:
        level = left / max(1, sum(w for s, w in weight.items() if s not in target))
        over = [s for s in order if s not in target and level * weight[s] >= 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
    target |= {s: level * weight[s] for s in order if s not in target}
    out = []
    for s in order:
        mine = sorted(((int(hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()[:12], 16), i, size(t)) for i, t, x in rows if x == s), key=lambda x: x[0])
        rounds = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, run = int(target[s] - rounds * sizes[s] + 1e-9), 0
        for h, i, n in mine:
            run = sum(m for g, _, m in mine if g <= h)
            out.append((i, n, sizes[s], round(target[s], 6), n * (rounds + (run <= rest))))
    return sorted(out, key=str)


def test_run_is_the_plain_loops(spark, sf):
    got = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in corpus_pipeline.run(spark, sf).collect()), key=str)
    assert got == plain(spark, sf)


def test_stages_keep_the_columns(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0 and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontamination", "secrets", "mixing"]
