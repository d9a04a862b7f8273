"""URL filter: host rules, then naive Bayes over words that a unigram Viterbi splits hosts into.

Rules are (host, path) pairs; a rule fits its host and all subdomains if the url's path starts with
the rule's, and the longest that fits decides. Urls that fit no rule are judged by the method: host
labels and path pieces are split into words by the most likely segmentation under unigram counts
(Viterbi), and a multinomial naive Bayes, learned from the urls that rules decide, weighs host and
path words. Words that it hasn't seen don't count.

Unigrams are counted over page texts, without blank-separated parts that hold '://' or a dot between letters or
digits (urls and hosts), and over paths; hosts are left
out, else a concatenated name would be a word of its own. All words seen `least` times or more are used, of 2 to `longest`
letters (a piece without known words stays whole, in parts of `longest` letters). Neither they nor the words' weights are ever
gathered: each distinct piece meets the counts of its own substrings by a join, and each url shape the weights of its words.
Each distinct host and path shape (digits folded) is split once; a shape of many pages, and a word of many
shapes, meet their other side in several tasks.

Defined cases: a null url, or one without '://', has an empty host and path, fits no rule and gets the
verdict of the classes' prior (allow in a tie). If rules decide no url, all others are allowed. Null
page ids and repeated rows come back as they are. An empty table gives an empty result. Other columns
than page_id, url and html are not read.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii

SALTS = 16  # parts that a frequent key is dealt to

#: verdict, host and path
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules=RULES) -> tuple[Column, Column]:
    """Rule text and verdict for columns host and path, null where none fits; the longest first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        text, verdict = F.when(fits, f"{host}{path}").otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def pieces(text: str, most: int = 1000) -> list[str]:
    """Runs of letters, in parts of `most` letters where they are longer, and one mark for each run of digits."""
    runs = re.findall(r"[^\W\d_]+|\d+", text.lower())
    return [y for x in runs for y in (["#"] if x[0].isdigit() else [x[i : i + most] for i in range(0, len(x), most)])]


class Segmenter:
    """Most likely split under unigram log probabilities; an unknown word costs more with its length."""

    def __init__(self, counts: dict[str, int], longest: int = 24):
        total = sum(counts.values()) + 1
        self.cost = {w: -math.log10(c / total) for w, c in counts.items()}
        self.unknown, self.longest = math.log10(total), longest

    def split(self, text: str) -> list[str]:
        best, back = [0.0], [0]
        for i in range(1, len(text) + 1):
            at, low = i - 1, math.inf
            for j in range(max(0, i - self.longest), i):
                c = best[j] + self.cost.get(text[j:i], self.unknown + 1.0 + (i - j))
                if c < low:
                    at, low = j, c
            best.append(low)
            back.append(at)
        out, i = [], len(text)
        while i:
            out.append(text[back[i] : i])
            i = back[i]
        return out[::-1]


def segmented(piece: str, counts: dict[str, int], total: int, longest: int = 24) -> list[str]:
    """A piece's words under the counts of its substrings and the number of all words; runs of unknown letters are one word."""
    if piece == "#":
        return [piece]
    seg = Segmenter({}, longest)
    seg.cost = {w: -math.log10(c / (total + 1)) for w, c in counts.items()}
    seg.unknown = math.log10(total + 1)
    return seg.split(piece)


def word_counts(pages: DataFrame, least: int = 2, longest: int = 24) -> DataFrame:
    """(w, c) of the words in page texts and paths; see above."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    plain = F.filter(F.split(text, r"\s+"), lambda t: ~(t.contains("://") | (t.contains(".") & t.rlike(r"[\p{L}\d]\.[\p{L}\d]"))))
    text = F.array_join(plain, " ")
    words = pages.select(F.explode(F.split(F.lower(F.concat_ws(" ", path_of(F.col("url")), text)), r"[^\p{L}]+")).alias("w"))
    return words.where(f"length(w) between 2 and {longest}").groupBy("w").agg(F.count("*").alias("c")).where(F.col("c") >= least)


def shapes(rows: DataFrame) -> DataFrame:
    """rows (host, shape, said): each shape once, with how many pages rules allow, block and leave open, and the
    pieces of its host and path."""
    kinds = rows.groupBy("host", "shape").agg(F.count(F.when(F.col("said") == "allow", 1)).alias("allow"), F.count(F.when(F.col("said") == "block", 1)).alias("block"), F.count(F.when(F.col("said").isNull(), 1)).alias("open"))

    def each(batches):
        kind = pa.list_(pa.string())
        for b in batches:
            own, path = ([pieces(x) for x in b.column(c).to_pylist()] for c in (0, 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, kind), pa.array(path, kind)], [*b.schema.names, "of_host", "of_path"])

    return kinds.mapInArrow(each, "host string, shape string, allow long, block long, open long, of_host array<string>, of_path array<string>").withColumn("key", F.xxhash64("host", "shape"))


def splits(parts: DataFrame, words: DataFrame, total: int, longest: int = 24) -> DataFrame:
    """parts (piece), distinct: (piece, words) with the words that it is split into."""
    subs = F.expr(f"array_distinct(flatten(transform(sequence(1, length(piece)), i -> transform(sequence(2, {longest}), n -> substr(piece, i, n)))))")
    rows = parts.select("piece", F.explode(subs).alias("w")).where("length(w) > 1")
    known = rows.join(words, "w").groupBy("piece").agg(F.map_from_entries(F.collect_list(F.struct("w", "c"))).alias("counts"))  # a piece's substrings

    def each(batches):
        for b in batches:
            got = [segmented(x, dict(m or ()), total, longest) for x, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.string()))], ["piece", "words"])

    return parts.join(known, "piece", "left").select("piece", "counts").mapInArrow(each, "piece string, words array<string>")


def meet(many: DataFrame, one: DataFrame, on: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """Join of a table with one that has each key once; rows of a frequent key are dealt to SALTS tasks."""
    every = one.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return many.withColumn("salt", F.pmod(salt, F.lit(SALTS)).cast("long")).join(every, [*on, "salt"], how).drop("salt")


def judge(pages: DataFrame, rules=RULES, least: int = 2, longest: int = 24, id_col: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row; score is the log odds of block, null where a rule decides."""
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    text, verdict = rule_for(rules)
    rows = rows.select("*", text.alias("rule"), verdict.alias("said"), F.regexp_replace("path", r"\d+", "0").alias("shape"))
    kinds = cut(shapes(rows), "url-shapes")
    words = cut(word_counts(pages, least, longest), "url-words")
    total = int(words.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    used = kinds.select("key", F.explode(F.concat(F.transform("of_host", lambda x: F.struct(F.lit("h:").alias("place"), x.alias("piece"))), F.transform("of_path", lambda x: F.struct(F.lit("p:").alias("place"), x.alias("piece"))))).alias("x")).select("key", "x.*")
    split = cut(splits(used.select("piece").distinct(), words, total, longest), "url-splits")
    tokens = meet(used, split, ["piece"], F.col("key")).select("key", F.explode(F.transform("words", lambda w: F.concat(F.col("place"), w))).alias("token"))
    tokens = cut(tokens, "url-tokens")

    counts = kinds.where("allow + block > 0").select("key", "allow", "block")
    prior = counts.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    seen = cut(tokens.join(counts, "key").groupBy("token").agg(F.sum("allow").alias("a"), F.sum("block").alias("b")), "url-counts")
    size = seen.agg(F.count("*"), F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    odds = seen.select("token", (F.log((F.col("b") + 1) / float(size[2] + size[0] or 1)) - F.log((F.col("a") + 1) / float(size[1] + size[0] or 1))).alias("odds"))
    base = math.log((prior[1] + 1) / (prior[0] + 1)) if prior[0] + prior[1] else -1.0
    asked = tokens.join(kinds.where("open > 0").select("key"), "key", "left_semi")
    scored = meet(asked, odds, ["token"], F.col("key")).groupBy("key").agg(F.sum("odds").alias("odds"))
    scored = kinds.where("open > 0").select("key", "host", "shape").join(scored, "key", "left").select("host", "shape", (F.coalesce("odds", F.lit(0.0)) + base).alias("score"))
    fine = meet(rows.where("said is null"), cut(scored, "url-scores"), ["host", "shape"], F.xxhash64("id", "path"))
    fine = fine.select("id", "host", "path", "rule", F.when(F.col("score") > 0, "block").otherwise("allow").alias("verdict"), "score")
    return rows.where("said is not null").select("id", "host", "path", "rule", F.col("said").alias("verdict"), F.lit(None).cast("double").alias("score")).union(fine)
