"""URL verdicts against a plain naive Bayes over a plain Viterbi."""

import math
import random
import re
from collections import Counter

from evidentia.llm import urls

WORDS = "casino win free bets news daily garden tool shop house plan bank loan quick music".split()


def pages():
    r = random.Random(4)
    rows = []
    for i in range(200):
        name = "".join(r.sample(WORDS, r.randint(1, 3)))
        path = r.choice(["/fr/", "/de/", "/es/", "/en/"]) + "/".join(r.choice(WORDS) + r.choice(["", "-" + r.choice(WORDS), str(r.randint(1, 99))]) for _ in range(r.randint(0, 3)))
        html = f"<html><script>casinowin casinowin</script><p>{' '.join(r.choice(WORDS) for _ in range(30))} see http://{name}.com/x and {name}.com</p></html>"
        rows.append((i, f"http://{r.choice(['', 'www.', 'm.'])}{name}.{r.choice(['com', 'org', 'net', 'io'])}{path}", html))
    rows += [(300, None, None), (301, "no url", ""), (302, "ftp://x", "<b>"), (None, rows[0][1], None), rows[5], rows[5], (303, "http://" + "q" * 70 + ".net/" + "z" * 5000, "w " * 90_000)]
    return rows


def brute(rows, least=2, longest=24):
    def host(u):
        m = re.match(r"(?s).*?://([^/?#]*)", u or "")
        return "".join(c.lower() if c.isascii() else c for c in m[1]) if m else ""

    def path(u):
        m = re.match(r"(?s).*?://[^/?#]*([^?#]*)", u or "")
        return m[1] if m else ""

    def rule(h, p):
        fit = [(len(x + y), k) for k, x, y in urls.RULES if (h == x or h.endswith("." + x)) and p.startswith(y)]
        return max(fit)[1] if fit else None

    count = Counter()
    for _, u, html in rows:
        t = re.sub(r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ", html or "")
        t = " ".join(x for x in t.split() if "://" not in x and not re.search(r"[^\W_]\.[^\W_]", x))
        count.update(w for w in re.split(r"[^a-z]+", f"{path(u)} {t}".lower()) if 2 <= len(w) <= longest)
    count = {w: c for w, c in count.items() if c >= least}
    seg, memo = urls.Segmenter(count, longest), {}

    def words(x):
        if x not in memo:
            memo[x] = ["#"] if x == "#" else seg.split(x)
        return memo[x]

    def tokens(u):
        return [f"h:{w}" for p in urls.pieces(host(u)) for w in words(p)] + [f"p:{w}" for p in urls.pieces(re.sub(r"\d+", "0", path(u))) for w in words(p)]

    n, total = {"allow": Counter(), "block": Counter()}, Counter()
    for _, u, _ in rows:
        if k := rule(host(u), path(u)):
            n[k].update(tokens(u))
            total[k] += 1
    seen = set(n["allow"]) | set(n["block"])
    out = []
    for i, u, _ in rows:
        k = rule(host(u), path(u))
        s = math.log((total["block"] + 1) / (total["allow"] + 1)) + sum(math.log((n["block"][t] + 1) / (sum(n["block"].values()) + len(seen))) - math.log((n["allow"][t] + 1) / (sum(n["allow"].values()) + len(seen))) for t in tokens(u) if t in seen)
        out.append((i, k or ("block" if s > 0 else "allow"), None if k else s))
    return out


def test_verdicts_and_scores(spark):
    rows = pages()
    d = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, shape string")
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r.id, r.verdict, r.score) for r in urls.judge(d).collect()), key=key)
    for g, w in zip(got, sorted(brute(rows), key=key), strict=True):
        assert g[:2] == w[:2] and (g[2] is None) == (w[2] is None) and (w[2] is None or abs(g[2] - w[2]) < 1e-9)


def test_a_concatenated_host_is_split(spark):
    rows = [(i, "http://casinowin.net/a", "casino and win and casino or win") for i in range(50)] + [(99, "http://x.org/y", "<p>casinowin.net http://casinowin.net/</p>")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    words = urls.word_counts(d)
    assert {r.w for r in words.collect()} == {"casino", "win", "and", "or"}
    parts = spark.createDataFrame([("casinowin",), ("qqq",), ("#",)], "piece string")
    assert {r.piece: r.words for r in urls.splits(parts, words, 200).collect()} == {"casinowin": ["casino", "win"], "qqq": ["qqq"], "#": ["#"]}


def test_without_rules_or_rows(spark):
    d = spark.createDataFrame([(1, "http://a.net/", "x"), (2, None, None)], "page_id long, url string, html string")
    assert {(r.id, r.verdict, r.rule) for r in urls.judge(d).collect()} == {(1, "allow", None), (2, "allow", None)}
    assert urls.judge(d.limit(0)).count() == 0
