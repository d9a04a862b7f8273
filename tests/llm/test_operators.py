"""Each operator against brute force, and its defined cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from evidentia.llm import decontam, lm, media, mixing, quality, secrets, simhash, toxicity, urls, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, size string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", "z") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abdeno") for _ in range(r.randint(2, 6))) for _ in range(120)]
    rows = []
    for i in range(80):
        t = " ".join(r.choice(words) for _ in range(r.randint(40, 120)))
        rows.append((i, t, f"s{i % 4}"))
    rows += [(100, rows[3][1], "s1"), (101, rows[3][1] + " tail", None), (3, rows[3][1], "s1")]
    rows += [(102, None, "s0"), (103, "", None), (None, "one two", "s2"), (104, "a\x0bB\tc " * 9000, "s0")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash(docs, rows, empty):
    fps = [brute_fp(t) for _, t, _ in rows]
    own = classes(fps)
    least = {}
    for (i, _, _), c in zip(rows, own, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(((i, f, least.get(c)) for (i, _, _), f, c in zip(rows, fps, own, strict=True)), key=str)
    got = sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in simhash.simhash_classes(docs).collect()), key=str)
    assert got == want
    assert simhash.simhash_classes(empty).count() == 0
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted({x for x in least.values()} | {i for i, _, _ in rows if i is None}, key=str)


@pytest.mark.parametrize("tile", [4, 50, 4096])
def test_links_in_tiles(spark, tile):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(60)]
    fps = list({x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for x in base for _ in range(6)} | {base[0] ^ (1 << i) for i in range(60)})
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tile=tile).collect()
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        assert bin((a ^ b) % (1 << 64)).count("1") <= 64
        root[find(a)] = find(b)
    own = classes(fps)
    pairs = {(i, j) for i in range(len(fps)) for j in range(i) if own[i] == own[j]}
    assert pairs == {(i, j) for i in range(len(fps)) for j in range(i) if find(signed[i]) == find(signed[j])}


def test_toxicity(spark, docs, empty):
    t = toxicity.Folds()
    assert toxicity.fold("1D10T!", t).strip() == "idiot" and toxicity.fold("іdіоt", t).strip() == "idiot"
    auto = toxicity.automaton({" idiot ": 2.0, " trash ": 2.0, " lowe": 1.0})
    assert toxicity.matched(toxicity.fold("idiot idiot, trash can; trash loweber", t), auto) == 7.0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = frame(spark, [(1, "you idiot moron scum", None), (2, "fine words here", None), (3, None, None), (None, "", None)])
    got = toxicity.score(few, labels).collect()
    assert [r.predicted for r in got] == [0] * 4 and len({r.score for r in got}) == 1  # nothing is known
    one = toxicity.score(few, spark.createDataFrame([(i, 1, 1) for i in range(9)], labels.schema)).collect()
    assert [r.predicted for r in one] == [1] * 4
    assert all(0 <= r.score <= 1 for r in got) and toxicity.score(empty, labels).count() == 0


def test_toxicity_and_quality_held_out(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdeiou") for _ in range(r.randint(2, 7)))
    rows, labels = [], []
    for i in range(700):
        bad, low = i % 4 == 0, i % 5 == 0
        t = " ".join([word() for _ in range(60)] + ["zugrom", "zugrat"] * (2 * bad))
        rows.append((i, " ".join(w + "%%%" for w in t.split()) if low else t, None))
        labels.append((i, int(not low), int(bad)))
    d, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for got, k, by, held in ((toxicity.score(d, lab), 2, 5, 0), (quality.score(d, lab), 1, 4, 2)):
        out = [x for x in got.collect() if x.held_out]
        assert all(zlib.crc32(str(x.doc_id).encode()) % by == held for x in out)
        assert sum(x.predicted == labels[x.doc_id][k] for x in out) >= 0.97 * len(out)


def test_quality_chunks_and_cases(spark, docs, empty):
    net = quality.init()
    for n in (0, 1, 447, 512, 513, 5000, 200_000):
        raw = random.Random(n).randbytes(n)
        c = quality.chunks(raw)
        assert len(c) == quality.n_chunks(n) and (len(c) - 1) * quality.STEP + quality.CHUNK >= n
        assert abs(quality.many([raw, b"x"], net)[0] - quality.probability(raw, net, 7)) < 1e-5
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, none).count() == docs.count() and quality.score(empty, none).count() == 0


def test_media_round_trip(docs, rows, empty):
    for r in media.round_trip(docs).collect():
        options = [t for i, t, _ in rows if i == r.doc_id]
        want = [media.padded(t) for t in options]
        assert any((r.n_bytes, r.payload_bytes, r.tail_crc32) == (n, len(p), zlib.crc32(p[-16:])) for p, n in want)
    assert media.round_trip(empty).count() == 0
    p, _ = media.padded("Grüße, " * 500)
    d = media.Decoder()
    (g,) = media.load([media.store(p)], d)
    assert g.tobytes() == p
    frame0 = media.read_avi(media.store(p))[0][0]
    assert (d.pixels(frame0)[0, ::8, ::8].tobytes() == p[:192]) and media.parse_jpeg(frame0)[0]["wide"] == 128
    with pytest.raises(ValueError):
        media.read_avi(b"not an avi file")


def test_media_frames_with_ac_and_shots():
    # a frame whose first block has one AC coefficient: DC 5, then run 0 size 1
    dc, ac = media.codes(media.DC_BITS, media.DC_VALUES), media.codes(media.AC_BITS, media.ac_values(media.AC_FIRST))
    bits = ""
    for block in range(media.UNIT):
        d = 5 if block == 0 else 0
        code, n = dc[d.bit_length()]
        bits += format(code, f"0{n}b") + (format(d, "b") if d else "")
        if block == 0:
            bits += format(ac[1][0], f"0{ac[1][1]}b") + "1"
        bits += format(ac[0][0], f"0{ac[0][1]}b")
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    px = media.Decoder().pixels(media.HEAD + scan + media.END)[0]
    want = 128 + 5 + np.outer(media.DCT[0], media.DCT[1])
    assert (px[:8, :8] == np.rint(want)).all() and (px[:8, 8:] == 133).all()
    greys = np.concatenate([np.full((20, 192), 30), np.full((15, 192), 200)]).astype(np.uint8)
    assert media.shots(media.histograms(greys)) == [(0, 20), (20, 35)] and media.shots(media.histograms(greys[:0])) == []


def test_media_clips(spark, docs):
    flat = b"\x1e" * 192 * 10 + b"\xc8" * 192 * 5
    files = spark.createDataFrame([(1, media.store(flat)), (2, None)], "id long, media binary")
    assert [(r.id, r.clip, r.frames, r.start_s) for r in media.clips(files).collect()] == [(1, 0, 10, 0.0), (1, 1, 5, 0.4)]
    assert media.encode_documents(docs).where("length(media) > 0").count() == docs.count()


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, "If Anna buys 12 apples for 3 dollars, then how much does Anna pay for 12 apples?", "c"), (2, None, "c"), (3, "tiny words", "c")], "item_id long, text string, lang string")
    got = frame(spark, [
        (1, "noise if Anna buys 12 apples for 3 dollars, then how much does Anna pay for 12 apples? noise", None),
        (2, "noise. If Berta buys 15 apples for 7 dollars, then how much does Berta pay for 15 apples?", None),
        (3, "noise. If Berta buys 15 apples for 7 dollars, then how much does Carla pay for 90 apples?", None),
        (4, "how much does it cost to buy apples for a week if you pay then", None), (5, "some tiny words here", None), (6, None, None), (6, "x " * 30000, None), (None, "", None),
    ])
    out = {r.doc_id: (r.contaminated, r.item_ids, r.other_slots) for r in decontam.contaminated(got, items).collect()}
    assert out[1] == (True, [1], False) and out[2] == (True, [1], True) and out[5] == (True, [3], False)
    assert not out[3][0] and not out[4][0] and not out[6][0] and not out[None][0]
    assert decontam.contaminated(got, items).count() == 8 and decontam.keep_clean(got, items).count() == 5
    assert decontam.contaminated(empty, items).count() == 0 and decontam.keep_clean(got, items.limit(0)).count() == 8


def test_mixing(spark, docs, rows, empty):
    got = mixing.mix(docs).collect()
    size = lambda t: len((t or "").encode().split())
    total = Counter()
    for _, t, s in rows:
        total[s] += size(t)
    names = sorted((s for s in total if s is not None)) + [s for s in total if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        level = left / max(1, sum(weight[s] for s in names if s not in capped))
        more = {s for s in names if s not in capped and level * weight[s] > 3 * total[s]}
        if not more:
            break
        capped |= more
    target = {s: 3.0 * total[s] if s in capped else level * weight[s] for s in names}
    taken = Counter()
    for r in got:
        options = [s for i, t, s in rows if i == r.doc_id and size(t) == r.size and total[s] == r.source_size]
        assert any(abs(target[s] - r.target) < 1e-6 * max(1, r.target) for s in options)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source_size] += r.taken
    for s in names:
        assert taken[total[s]] <= target[s] + 1e-6 and target[s] - taken[total[s]] <= max(size(t) for _, t, x in rows if x == s) or list(total.values()).count(total[s]) > 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(empty).count() == 0
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, None)])).collect()] == [0]


def test_secrets(spark, empty):
    trees = secrets.fit(spark)
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    d = frame(spark, [(1, f'words token = "{key}" more {key}', None), (2, "card 4785380592391139 paid", None), (3, f"commit {key} merged", None), (4, None, None), (5, "", None), (None, "plain words " * 9000, None)])
    got = {r.doc_id: [(x.value, x.secret) for x in r.findings] for r in secrets.scan(d, trees).collect()}
    assert (key, True) in got[1] and got[2] == [("4785380592391139", False)] and got[3] == [(key, False)] and got[4] == got[5] == got[None] == []
    out = {r.doc_id: r.text for r in secrets.redact(d, trees).collect()}
    assert out[1] == 'words token = "[SECRET]" more [SECRET]' and out[3] == f"commit {key} merged" and out[4] is None
    assert secrets.redact(d, trees).columns == d.columns and secrets.scan(empty, trees).count() == 0


def test_forest_as_sql_and_held_out(spark):
    trees = secrets.fit(spark)
    other = spark.createDataFrame(secrets.default_findings(600, seed=99), "value string, before string, after string, y int")
    f = other.select("y", secrets.features(F.col("value"), F.col("before"), F.col("after")).alias("f"))
    out = f.select("y", "f", secrets.as_column(trees, F.col("f")).alias("p")).collect()
    assert all(abs(r.p - secrets.vote(trees, tuple(r.f))) < 1e-12 for r in out)
    assert sum((r.p >= 0.5) == bool(r.y) for r in out) > 0.95 * len(out)


def test_urls(spark):
    seg = urls.Segmenter({"free": 50, "bets": 40, "news": 60, "be": 5})
    assert seg.split("freebetsnews") == ["free", "bets", "news"]

    def best(text):  # all splits
        if not text:
            return 0.0, []
        return min(((c + seg.cost.get(text[:i], seg.unknown + 1.0 + i), [text[:i], *w]) for i in range(1, len(text) + 1) for c, w in [best(text[i:])]))

    for t in ("newsfree", "xbetsq", "bebets"):
        assert seg.split(t) == best(t)[1]
    rows = [
        (1, "http://a.org/x", "org/", "allow"), (2, "http://B.Example.ORG/es/1", "example.org/es/", "block"), (3, "https://example.org/en/12", "example.org/en/1", "block"), (4, "http://x.com/fr/1?q#z", "com/fr/", "allow"),
        (5, "http://x.com/de/", "com/de/", "block"), (6, "http://xorg/x", None, None), (7, "no url", None, None), (8, None, None, None), (9, "http://a.org", None, None), (10, "http://notexample.org/es/", "org/", "allow"),
    ]
    p = spark.createDataFrame([(i, u, None, "k") for i, u, _, _ in rows], "page_id long, url string, html string, host string").select("page_id", "url", "html")
    got = {r.id: r for r in urls.judge(p).collect()}
    for i, _, rule, verdict in rows:
        assert got[i].rule == rule and got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")
    assert (got[2].host, got[2].path, got[4].path, got[7].host) == ("b.example.org", "/es/1", "/fr/1", "")
    assert urls.judge(p.limit(0)).count() == 0


def test_elias_fano_and_trie(tmp_path):
    r = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 2**63), (20000, 10**12)):
        v = np.unique(r.integers(0, top, n).astype(np.uint64))
        e = lm.EliasFano(lm.EliasFano.pack(v))
        assert (e.all() == v).all() and (e.find(v) == np.arange(len(v))).all()
        q = np.setdiff1d(r.integers(0, top, 500).astype(np.uint64), v)
        assert (e.find(q) == -1).all()
        m = len(v) // 2
        assert (e.find(v[:m], np.zeros(m, int), np.full(m, m)) == np.arange(m)).all() and (e.find(v[m:], np.zeros(len(v) - m, int), np.full(len(v) - m, m)) == -1).all()
    words = np.array([3, 5, 9, 77, 2**60], np.uint64)
    raw = lm.Trie.build(words, np.array([1, 1, 1, 2]), np.array([1, 2, 4, 3]), np.array([1, 2, 1, 2]), np.array([4, 4, 4, 3]))
    (tmp_path / "t").write_bytes(raw)
    t = lm.Trie.open(str(tmp_path / "t"))
    asked = np.array([5, 9, 77, 8, 2**60], np.uint64)
    weight, share = t.look(asked, np.array([0, 0, 1, 3, 1, 0, 0, 2]), np.array([1, 2, 2, 0, 1, 0, 4, 1]))
    assert np.allclose(lm.decoded(weight, 1.0), [0.75 * 3 / 4, 0.75 / 3, 1, 1, 1], rtol=1e-3)
    assert np.allclose(lm.decoded(share, 0.0), [1.25 / 4, 0, 1.25 / 3, 0, 0, 0.25 / 4, 0.25 / 4, 0], rtol=1e-3)


def scores(rows):
    """Brute force: (id, tokens, known, N, base, score) of each (id, text)."""
    tokens = [(i, [*(t or "").encode().lower().split(), b"\n"]) for i, t in rows]
    train = [ws for i, ws in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    count = Counter(w for ws in train for w in ws)
    n, v, pairs, heads = sum(count.values()), len(count), Counter(), Counter()
    for ws in train:
        pairs.update(zip([b" ", *ws[:-1]], ws, strict=True))
        heads.update([b" ", *ws[:-1]])
    kinds = Counter(a for a, _ in pairs)
    uni = {w: (count[w] + 0.5) / (n + 0.5 * (v + 1)) for _, ws in tokens for w in ws}

    def p(a, b):
        return (max(pairs[a, b] - 0.75, 0) + 0.75 * kinds[a] * uni[b]) / heads[a] if heads[a] else uni[b]

    return [(i, len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10(uni[w]) for w in ws), sum(math.log10(p(a, b)) for a, b in zip([b" ", *ws[:-1]], ws, strict=True))) for i, ws in tokens]


def test_lm(docs, rows, empty):
    key = lambda r: (str(r[0]), r[1])
    want = sorted(scores([r[:2] for r in rows]), key=key)
    by_shards = []
    for shards, at_once in ((5, 1 << 13), (17, 1 << 20), (1, 1 << 20)):  # contexts are split, or aren't
        got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score(docs, shards=shards, at_once=at_once).collect()), key=key)
        for g, w in zip(got, want, strict=True):
            assert g[:4] == w[:4] and abs(g[4] - w[4]) < 1e-6 * (1 + abs(w[4])) and abs(g[5] - w[5]) < 0.0003 * w[1]  # codes
        by_shards.append([g[5] for g in got])
    assert np.allclose(by_shards[0], by_shards[1], rtol=1e-3) and np.allclose(by_shards[1], by_shards[2], rtol=1e-3)
    assert lm.score(empty, shards=3).count() == 0
    untrained = lm.score(docs.where("doc_id = 3").select(F.lit(2).alias("doc_id"), "text").limit(1), held=zlib.crc32(b"2") % 5).collect()
    assert [(r.n_known, r.train_tokens) for r in untrained] == [(0, 0)] and abs(untrained[0].score - untrained[0].base_score) < 1e-9


def test_warc(spark):
    big = "x" * 1500
    rows = [(1, "http://a/", big), (2, None, big), (2, "u\r\nv", big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (6, "u", "é" * 999), (7, "u", "long " * 50000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, sha1 string").select("page_id", "url", "html")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    kind = Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kind[1, "revisit", 2] == 1 and kind[2, "response", None] == 2 and kind[None, "revisit", 2] == 1 and kind[3, "response", None] == kind[4, "response", None] == kind[5, "response", None] == 1
    html = {i: (h or "").encode() for i, _, h in rows}
    assert all(r.payload_bytes == len(html[r.page_id]) and (r.payload is None or bytes(r.payload) == html[r.page_id]) for r in got)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_zip64_directory():
    import io
    import zipfile

    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as m:
            m.write(b"hello world")
        z.writestr("packed", b"y" * 900, zipfile.ZIP_DEFLATED)
        z.comment = b"note"
    raw = f.getvalue()
    got = warc.ZipRanges(lambda o, n: raw[o : o + n], len(raw))
    assert got.range("a", 6, 5) == b"world" and "packed" not in got.members
    with pytest.raises(ValueError):
        got.range("a", 6, 6)
