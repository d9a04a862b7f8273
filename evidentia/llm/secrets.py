"""Secret scan with DataFrame expressions only.

Candidates are found by one regular expression: blocks of private keys; passwords inside URLs; values that are assigned
to a name with a secret word in it, six signs or longer; and runs of key characters, 16 or longer with a digit in them or
32 or longer without. A random forest decides which are secrets: it is trained on labelled findings (value, before, after,
y), on features that the same SQL expressions compute: length, character transitions and shares, dictionary coverage, path
marks, and neighbouring words. The forest becomes one SQL expression, so that scoring runs inside Catalyst without Python.
Without labelled findings of the caller, the documented generator `default_findings` makes them from public key formats,
made-up passwords and the usual false positives (checksums, commits, card numbers, paths, placeholders, references).

No shuffle: every document is scanned where it is, over its whole text. Texts are read once, and once more where
something is found.

Defined cases: null and empty texts have no candidates. A value that stands in a text several times is
judged at each place and redacted at each place where it is a candidate if it is a secret at any; other strings that hold
it stay. Null ids and repeated rows come back. An empty table gives an empty result. Other columns are kept as they are;
where one has the name of a new column, whatever the case, the new one gets '_' behind its name.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = r"A-Za-z0-9+/_\-"
#: what comes before a value that is assigned, and before a password in a URL
ASSIGNED = r"""(?i:passw(?:or)?d|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)[A-Za-z0-9_]{0,16}["'`]?[ \t]{0,2}(?:=>|:=|=|:)[ \t]{0,2}["'`]?"""
IN_URL = r"""://[^\s:/@"'<>]{1,64}:"""
VALUE = r"""[^\s"'`<>,;]"""
PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[\s\S]*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
RUN = rf"(?<![{KEY}])(?:(?=[A-Za-z+/_\-]*+[0-9])(?=[{KEY}]{{16}})|(?=[{KEY}]{{32}}))[{KEY}]++={{0,2}}"
CANDIDATE = rf"{PEM}|{IN_URL}[^\s:/@\"'<>]{{3,}}(?=@)|{ASSIGNED}{VALUE}{{6,}}|{RUN}"
#: the part of a candidate that isn't its value
PREFIX = rf"^(?:{IN_URL}(?=[^\s:/@\"'<>]{{3,}}$)|{ASSIGNED}(?={VALUE}{{6,}}$))"
#: one of them, in any case, stands in what ASSIGNED matches
ASKING = ("passw", "passphrase", "pwd", "secret", "token", "api", "key", "credential")
DICTIONARY = "test example sample dummy placeholder your here user name file path image images assets static config version build number index page article product order item date home data value list table main class function method default local public system service server client request response content media upload download document report release final draft copy group type code line first last next password changeme required none null true false string please reset token secret login enter empty unknown".split()
SECRET_WORDS = r"(?i)(token|secret|passw(or)?d|passwd|passphrase|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential|client[_-]?secret|signing)"
OTHER_WORDS = r"(?i)(sha-?\d*|md5|commit|checksum|digest|hash|uuid|guid|etag|isbn|order|card|phone|tel|tracking|version|rev(ision)?|ref|build|file|img|image|src|href|id|serial|invoice)\W*$"
FEATURES = ("length", "digits", "uppers", "vowels", "distinct", "transitions", "hexed", "plain", "longest_letters", "covered", "path", "asks", "assigns", "quoted", "others", "tail_path", "symbols", "block", "in_url", "refers")


def features(value: Column, before: Column, after: Column) -> Column:
    """Struct of the features, as doubles."""
    n = F.length(value).cast("double")
    low = F.lower(value)

    def share(pattern: str, c: Column = value) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    def flag(c: Column) -> Column:
        return c.cast("double")

    got = {
        "length": F.least(n, F.lit(128.0)),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "vowels": share("[aeiou]", low),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(40.0)),
        "transitions": share("(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])"),
        "hexed": flag(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "plain": flag(value.rlike("^[0-9]+$|^[A-Za-z]+$")),
        "longest_letters": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(low, F.lit("[a-z]+"), F.lit(0)), lambda x: F.length(x))), F.lit(0)) / n,
        "covered": (n - F.length(F.regexp_replace(low, "|".join(sorted(set(DICTIONARY), key=len, reverse=True)), ""))) / n,
        "path": flag((F.regexp_count(value, F.lit("/")) >= 2) | value.rlike("^/") | before.rlike(r"(://\S*|[/\\.]|www\S*)$")),
        "asks": flag(before.rlike(SECRET_WORDS)),
        "assigns": flag(before.rlike(r"""[=:]>?\s*["'`]?$""")),
        "quoted": flag(before.rlike(r"""["'`]$""")),
        "others": flag(before.rlike(OTHER_WORDS)),
        "tail_path": flag(after.rlike(r"^\.[a-z]{2,5}\b|^[/\\?]")),
        "symbols": share(r"[^A-Za-z0-9]"),
        "block": flag(value.startswith("-----BEGIN")),
        "in_url": flag(before.rlike(r"://[^\s:/@]*:$") & after.startswith("@")),
        "refers": flag(value.rlike(r"^[$%{\[(*#.]|^(os|env|process|config|settings|self|this|args|request|System)\b|[(\[{]|^(.)\2+$")),
    }
    return F.struct(*(got[k].cast("double").alias(k) for k in FEATURES))


def default_findings(n: int = 3200, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """Labelled findings (value, before, after, y) from public key formats, passwords, and the usual false positives."""
    r = random.Random(seed)
    hexed, upper, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda s, k: "".join(r.choice(s) for _ in range(k))
    spoken = lambda a, b: "".join(r.choice("bcdflmnrstvkgph") + r.choice("aeiou") + r.choice(["", "", "n", "r", "s"]) for _ in range(r.randint(a, b)))
    filler = lambda: " ".join("".join(r.choice("thernaosdilué") for _ in range(r.randint(2, 9))) for _ in range(r.randint(1, 6)))
    word = lambda: r.choice(DICTIONARY)
    keys = ["token", "secret", "password", "api_key", "apiKey", "access_key", "client_secret", "auth_token", "PRIVATE_KEY", "Authorization: Bearer", "passwd", "credential", "TOKEN", "DB_PASSWORD", "pwd", "passphrase"]
    names = lambda: f"{filler()} {r.choice(keys)}{r.choice((' = ', '=', ': ', ' := ', ' => '))}{r.choice(chr(34) + chr(39) + ' ')}"

    def key() -> tuple[str, str]:
        value = r.choice([lambda: draw(hexed, r.choice((32, 40, 48, 64))), lambda: draw(hexed, 40).upper(), lambda: draw(alnum, r.randint(20, 48)), lambda: draw(alnum + "+/", r.choice((40, 44, 64))), lambda: "AKIA" + draw(upper, 16), lambda: "ghp_" + draw(alnum, 36), lambda: "sk_live_" + draw(alnum, 24), lambda: "xoxb-" + draw("0123456789", 11) + "-" + draw(alnum, 24)])()
        plain = value.startswith(("AKIA", "ghp_", "sk_", "xoxb"))
        return value, r.choice([names()] * 4 + [f"{filler()} "] * plain + [f"{filler()} {r.choice(keys)} {r.choice(('is', 'was set to', '->'))} "])

    def password() -> str:
        base = r.choice([lambda: spoken(2, 4) + draw("0123456789", r.randint(1, 4)), lambda: spoken(2, 4).capitalize() + draw("0123456789", 2) + r.choice("!&#$?*"), lambda: draw(alnum + "!&#$?*-_.", r.randint(8, 20)), lambda: spoken(3, 5).replace("o", "0").replace("e", "3") + r.choice("!&#$?*"), lambda: "-".join(spoken(2, 3) for _ in range(4))])()
        return base if len(base) > 5 else base + draw("0123456789", 6 - len(base))

    def other() -> tuple[str, str, str | None]:
        kind, before = r.randrange(11), f"{filler()} "
        if kind == 0:
            return draw(hexed, r.choice((40, 32, 64))), f"{filler()} {r.choice(('commit', 'sha1:', 'sha256 =', 'md5', 'checksum:', 'rev', 'digest ='))} ", None
        if kind == 1:
            return draw("0123456789", r.randint(16, 24)), r.choice([before, f"{filler()} {r.choice(('card', 'order', 'phone', 'tracking', 'isbn'))}: "]), None
        if kind == 2:
            return "-".join(draw(hexed, k) for k in (8, 4, 4, 4, 12)), r.choice([before, f"{filler()} {r.choice(('uuid', 'id', 'guid'))}: "]), None
        if kind == 3:
            return "/".join([word(), word(), str(r.randint(1990, 2030)), f"{word()}-{word()}{r.randint(1, 99)}"]), r.choice([f"{filler()} https://www.x.org/", f"{filler()} /", before]), r.choice([".html ", ".png ", ".jpg", "/", " "])
        if kind == 4:
            return "_".join(word() for _ in range(r.randint(3, 5))) + str(r.randint(1, 9)), before, None
        if kind == 5:
            return r.choice([f"your_{word()}_key_here_{r.randint(1, 999)}", "x" * r.randint(6, 30), "1234567890abcdef1234", f"example-{word()}-token-{r.randint(1, 99)}", "0" * r.randint(16, 40), "*" * r.randint(6, 12), "changeme", f"your-{word()}"]), names(), None
        if kind == 6:
            return "".join(spoken(2, 3) for _ in range(r.randint(3, 5))) + r.choice(["", str(r.randint(1, 99))]), before, None
        if kind == 7:
            return f"{word()}-{word()}-{word()}-{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", before, None
        if kind == 8:
            return draw(hexed, r.choice((32, 40))), f"{filler()} {r.choice(('img', 'src=', 'etag', 'file', 'build'))} {r.choice(('/', chr(34), ''))}", None
        if kind == 9:
            return r.choice([lambda: f"${{{word().upper()}_PASSWORD}}", lambda: f"os.environ[{word().upper()}", lambda: f"process.env.{word().upper()}", lambda: f"{word()}({word()})", lambda: f"config.{word()}.{word()}", lambda: f"%{word()}%", lambda: f"get{word().capitalize()}Password()"])(), names(), None
        value = r.choice([word(), spoken(3, 4), word() + word(), spoken(2, 4) + r.choice(".!:")])
        return value if len(value) > 5 else value + word(), f"{filler()} {r.choice(('password', 'Password', 'token', 'secret', 'pwd'))}: ", r.choice([" ", ". ", " " + spoken(2, 4) + " "])

    out = []
    for _ in range(n):
        tail, y = r.choice(['" ', "' ", " ", '"### ', '"!! ', "\n", '", ', "; "]) + filler(), int(r.random() < 0.5)
        if y:
            kind = r.random()
            if kind < 0.6:
                value, before = key()
            elif kind < 0.85:
                value, before = password(), names()
            elif kind < 0.95:
                value, before, tail = password(), f"{filler()} {r.choice(('postgres', 'mysql', 'amqp', 'https', 'redis'))}://{word()}:", "@" + spoken(2, 4) + ".net/"
            else:
                kind, before = r.choice(["RSA ", "EC ", "", "OPENSSH "]), f"{filler()}\n"
                value = f"-----BEGIN {kind}PRIVATE KEY-----\n{draw(alnum, 60)}\n-----END {kind}PRIVATE KEY-----"
        else:
            value, before, own = other()
            tail = tail if own is None else own + filler()
        out.append((value, before[-40:], tail[:24], y))
    return out


def grow(rows: Sequence[Sequence[float]], y: Sequence[int], depth: int, r: random.Random, least: int = 4):
    """A tree as nested tuples (feature, threshold, left, right), or the share of ones."""
    ones = sum(y)
    if depth == 0 or len(y) < 2 * least or ones in (0, len(y)):
        return (ones + 0.5) / (len(y) + 1)
    best = None
    for f in r.sample(range(len(rows[0])), max(1, math.isqrt(len(rows[0])) + 1)):
        pairs = sorted(zip((x[f] for x in rows), y, strict=True))
        left = 0
        for i in range(1, len(pairs)):
            left += pairs[i - 1][1]
            if pairs[i][0] > pairs[i - 1][0] and least <= i <= len(pairs) - least:
                right, m = ones - left, len(pairs) - i
                impurity = left * (i - left) / i + right * (m - right) / m
                if best is None or impurity < best[0]:
                    best = (impurity, f, (pairs[i][0] + pairs[i - 1][0]) / 2)
    if best is None:
        return (ones + 0.5) / (len(y) + 1)
    _, f, at = best
    low = [i for i, x in enumerate(rows) if x[f] <= at]
    high = [i for i, x in enumerate(rows) if x[f] > at]
    return f, at, grow([rows[i] for i in low], [y[i] for i in low], depth - 1, r, least), grow([rows[i] for i in high], [y[i] for i in high], depth - 1, r, least)


def forest(rows: Sequence[Sequence[float]], y: Sequence[int], trees: int = 15, depth: int = 6, seed: int = 5) -> list:
    r, out = random.Random(seed), []
    for _ in range(trees):
        pick = [r.randrange(len(y)) for _ in y]
        out.append(grow([rows[i] for i in pick], [y[i] for i in pick], depth, r))
    return out


def vote(trees: list, row: Sequence[float]) -> float:
    """The forest's probability for one row of features."""
    total = 0.0
    for t in trees:
        while isinstance(t, tuple):
            t = t[2] if row[t[0]] <= t[1] else t[3]
        total += t
    return total / len(trees)


def as_column(trees: list, f: Column) -> Column:
    """The same as an expression over the struct of features."""

    def node(t) -> Column:
        return F.when(f[FEATURES[t[0]]] <= t[1], node(t[2])).otherwise(node(t[3])) if isinstance(t, tuple) else F.lit(float(t))

    total = node(trees[0])
    for t in trees[1:]:
        total = total + node(t)
    return total / len(trees)


def fit(spark: SparkSession, findings: DataFrame | None = None, most: int = 4000) -> list:
    """Forest from labelled findings; at most `most` of them, those with the smallest hash, are used."""
    if findings is None:
        findings = spark.createDataFrame(default_findings(), "value string, before string, after string, y int")
    sample = findings.orderBy(F.xxhash64("value", "before"), "value").limit(most)
    rows = sample.select("y", features(F.col("value"), F.col("before"), F.col("after")).alias("f")).collect()  # `most` at most
    return forest([tuple(r.f) for r in rows], [r.y for r in rows])


def free(name: str, columns: Sequence[str]) -> str:
    """name, with '_' behind it as often as a column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def may_hold(text: Column) -> Column:
    """True wherever CANDIDATE has a match, and cheap: most texts are told by one class of signs and by plain searches."""
    low, asks = F.lower(text), F.lit(False)
    for w in ASKING:
        asks = asks | low.contains(w)
    return text.rlike(f"[{KEY}]{{16}}") | text.contains("-----BEGIN") | (text.contains("://") & text.contains("@") & text.rlike(IN_URL)) | (asks & text.rlike(ASSIGNED))


def judged(docs: DataFrame, trees: list, least: float, text_col: str) -> tuple[DataFrame, str, str]:
    """docs with two more columns: candidates (prefix, value, score, secret) in order of place, and the pieces of the text
    between them, one more than candidates."""
    found = free("found", docs.columns)
    pieces = free("pieces", [*docs.columns, found])
    text = F.col(text_col).cast("string")
    rows = docs.withColumn(found, F.when(may_hold(text), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))))
    rows = rows.withColumn(found, F.coalesce(found, F.array().cast("array<string>")))
    rows = rows.withColumn(pieces, F.when(F.size(found) > 0, F.split(text, CANDIDATE, -1)).otherwise(F.array(F.coalesce(text, F.lit("")))))

    def parts(m: Column) -> Column:
        prefix = F.regexp_extract(m, PREFIX, 0)
        return F.struct(prefix.alias("prefix"), F.substr(m, F.length(prefix) + 1).alias("value"))

    rows = rows.withColumn(found, F.transform(found, parts))

    def described(x: Column, i: Column) -> Column:
        before, after = F.right(F.concat(F.right(F.get(pieces, i), F.lit(40)), x.prefix), F.lit(40)), F.left(F.get(pieces, i + 1), F.lit(24))
        return F.struct(x.prefix.alias("prefix"), x.value.alias("value"), features(x.value, before, after).alias("f"))

    rows = rows.withColumn(found, F.transform(found, described))
    rows = rows.withColumn(found, F.transform(found, lambda x: F.struct(x.prefix.alias("prefix"), x.value.alias("value"), as_column(trees, x.f).alias("score"))))
    return rows.withColumn(found, F.transform(found, lambda x: F.struct(x.prefix.alias("prefix"), x.value.alias("value"), x.score.alias("score"), (x.score >= least).alias("secret")))), found, pieces


def scan(docs: DataFrame, trees: list, least: float = 0.5, text_col: str = "text", out: str = "findings") -> DataFrame:
    """docs with column `out`: array of (value, score, secret), in order of place."""
    rows, found, _ = judged(docs, trees, least, text_col)
    return rows.select(*docs.columns, F.transform(found, lambda x: F.struct(x.value.alias("value"), x.score.alias("score"), x.secret.alias("secret"))).alias(free(out, docs.columns)))


def redact(docs: DataFrame, trees: list, least: float = 0.5, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """docs, same rows and columns, with each secret's value replaced in the text, place by place."""
    rows, found, pieces = judged(docs, trees, least, text_col)
    values = free("values", rows.columns)
    rows = rows.withColumn(values, F.array_distinct(F.transform(F.filter(found, lambda x: x.secret), lambda x: x.value)))
    kept = F.zip_with(found, F.slice(pieces, 2, F.greatest(F.size(found), F.lit(1))), lambda x, p: F.concat(x.prefix, F.when(F.array_contains(values, x.value), mark).otherwise(x.value), p))
    text = F.when(F.size(values) > 0, F.concat(F.get(pieces, F.lit(0)), F.array_join(kept, ""))).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).select(*docs.columns)
