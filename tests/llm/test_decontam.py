"""Decontamination against brute force, and its recall on changed questions."""

import random

from evidentia.llm import decontam

NAMES = "Anna Berta Carla Dora Emil Fritz Gustav Hans Ida Jonas Mary Paul Rosa Tim Ute".split()
THINGS = "apples pears books pens coins cards stones boxes shirts plates candles ropes".split()
VERBS = "buys sells finds loses paints carries counts borrows lends packs".split()


def question(r, who, n):
    a, b, c, d = (r.choice(THINGS) for _ in range(4))
    v, w, x = (r.choice(VERBS) for _ in range(3))
    return f"{who[0]} {v} {n[0]} {a} at the market near the old {b} and then {w} {n[1]} of them before noon. {who[1]} {x} the rest for {n[2]} dollars each. How many {c} does {who[0]} still need if every {d} holds {n[3]} of them?"


def unrelated(r, who):
    a, b = r.sample(THINGS, 2)
    return f"{who[0]} and {who[1]} walk to the market near the old bridge with {r.randint(2, 9)} {a}. They meet {r.randint(2, 9)} children on the way. How many {b} does {who[0]} still need to give each child the same number of {a}?"


def template(text):
    p = decontam.Templates().parse([text])
    return [("w", "<num>", "<name>", "<unit>")[k] if k else p.words.value[p.ids[f]] for k, f in zip(p.kind, p.first, strict=True)], [p.slots(i, 1) for i in range(len(p.kind)) if p.kind[i]]


def test_templates():
    assert template("The cat of Mary Ann cost 3 US dollars, 5 km. Anna ran 12.5 kg New York.") == (
        ["the", "cat", "of", "<name>", "cost", "<num>", "<unit>", "<num>", "<unit>", "<name>", "ran", "<num>", "<unit>", "<name>"],
        [["mary ann"], ["3"], ["dollars"], ["5"], ["km"], ["anna"], ["12.5"], ["kg"], ["new york"]],
    )
    assert template("3 dollars") == template("3 dollars !") and template("") == ([], []) and template("... --") == ([], [])
    one, two = decontam.Templates().parse(["Anna runs", "Berta 7"]), decontam.Templates().parse(["Anna runs Berta 7"])
    assert len(one.windows(3)[0]) == 0 and len(two.windows(3)[0]) == 2 and len(one.hashes) == 4


def brute(docs, items, least=0.8, drift=16, width=5):
    """Pairs by plain loops over positions."""
    out, t = set(), decontam.Templates()
    for d, text in docs:
        p = t.parse([text])
        for i, item in items:
            for q in (t.parse([item]), t.parse([(item or "").lower()])):
                k = min(width, len(q.hashes))
                if not k:
                    continue
                good = [x for x in range(len(q.hashes) - k + 1) if sum(q.kind[x : x + k] == 0) >= min(2, k)] or list(range(len(q.hashes) - k + 1))
                n = len({y for x in good for y in range(x, x + k)})
                met = [(x, y) for x in good for y in range(len(p.hashes) - k + 1) if (p.hashes[y : y + k] == q.hashes[x : x + k]).all()]
                for grid in (0, drift):
                    for line in {(y - x + grid) // (2 * drift) for x, y in met}:
                        here = [(x, y) for x, y in met if (y - x + grid) // (2 * drift) == line]
                        pairs = {z for x, y in here for z in zip(q.slots(x, k), p.slots(y, k), strict=True)}
                        values = {a for a, _ in pairs}
                        clear = sum(len({b for a2, b in pairs if a2 == a}) == 1 for a in values)
                        if len({x for x, _ in here}) >= 0.5 * len(good) and len({z for x, _ in here for z in range(x, x + k)}) >= least * n and clear >= least * len(values):
                            out.add((d, i))
    return out


def corpus():
    r = random.Random(6)
    noise = lambda n: " ".join(r.choice("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod".split()) for _ in range(n))
    items, docs, want = [], [], set()
    for i in range(18):
        seed, who, n = r.random(), r.sample(NAMES, 2), [r.randint(2, 99) for _ in range(4)]
        items.append((i, question(random.Random(seed), who, n)))
        other = question(random.Random(seed), r.sample(NAMES, 2), [r.randint(100, 999) for _ in range(4)])
        long = question(random.Random(seed), ["Mary Ann", "Paul Peter"], ["3 dozen".split()[0], 4, 5, 6]).replace(" dollars", " US dollars")
        words = items[-1][1].split()
        put, gone = [*words[:20], "really", *words[20:]], [*words[:20], *words[21:]]
        for text in (items[-1][1], other, long, " ".join(put), " ".join(gone), items[-1][1].lower(), items[-1][1].upper()):
            want.add((len(docs), i))
            docs.append((len(docs), f"{noise(r.randint(0, 40))}. {text} {noise(r.randint(0, 40))}"))
        docs.append((len(docs), noise(60)))
        docs.append((len(docs), unrelated(r, r.sample(NAMES, 2))))  # another question, with phrases in common
        docs.append((len(docs), " ".join(words[: len(words) // 2])))
    return docs, items, want


def test_brute_force_and_recall(spark):
    docs, items, want = corpus()
    items += [(100, "tiny item"), (101, None), (102, "")]
    docs += [(1000, "a tiny item here"), (1001, None), (1002, "")]
    want.add((1000, 100))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.findings(d, i).collect()}
    assert got == brute(docs, items)
    own = {(a, b) for a, b in got if (a, b) in want}
    assert len(own) >= 0.95 * len(want)
    assert {a for a, _ in got} <= {a for a, _ in want}  # clean documents are left alone


def test_common_windows_lose_nothing(spark, monkeypatch):
    docs, items, _ = corpus()
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    few = []
    for n in (1, 5, 64):
        monkeypatch.setattr(decontam, "FEW", n)
        few.append({tuple(r) for r in decontam.findings(d, i).collect()})
    assert few[0] == few[1] == few[2]
    monkeypatch.setattr(decontam, "MOST_BITS", 16)
    assert {tuple(r) for r in decontam.findings(d, i).collect()} == few[0]
