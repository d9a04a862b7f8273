"""Benchmark decontamination by templates.

Texts and benchmark items become template words: letters in lower case without outer signs; numbers, names
(capitalised words, but for common words that open a sentence) and units behind a number become typed placeholders,
whose values are the window's slots. Neighbouring placeholders of one type are one, and names between a number and its
unit are dropped, so that a value may have any number of words. Items are also taken in lower case, so that a copy
without capitals is found.

Windows of five template words are hashed and hash-joined with the benchmark's windows; a bitmap of the benchmark's
hashes, sized to it up to a fixed bound, keeps windows that can't join from leaving the scan, and the join itself is
Spark's, so a benchmark of any size works. Documents and items are paired by windows that few items have, wherever an
item can't be held without one of them, and only then are all windows of such pairs joined. Windows of nearly the same
shift against the item (within `drift` words) belong together: so words put in or left out between them don't matter. They
must be at least half of the item's windows and cover at least 0.8 of its words, and each slot value of the item must stand for one value in the document
(at least 0.8 of the item's values), so that a question with other numbers or names is caught and chance templates aren't.

Defined cases: null and empty texts are clean. An item with fewer words than a window is one window of
its own length; an item without words is ignored. Windows without two plain words are used only if the
item has no others. Rows with equal ids (nulls too) are judged together and each comes back. Null item
ids take part like any other. An empty table on either side gives no findings. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
UNITS = frozenset(
    "% $ € £ mm cm m km in ft yd mi mg g kg t lb oz ml l s sec secs min mins h hr hrs hour hours day days week weeks month months year years second seconds minute minutes meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram kilograms pound pounds ton tons liter liters litre litres dollar dollars euro euros cent cents percent degree degrees hz khz mhz ghz kb mb gb tb mph kmh w kw j n pa v a".split()
)
#: Words that are no names where they open a sentence.
OPENERS = frozenset(
    "a an the this that these those there here it its he she they we you i his her their our your my if when while where who whom whose which what why how then thus so and or but as at by for from in into of on to with after before during since until each every some any all both no not one is are was were do does did has have had can could will would should may might must let find given suppose calculate".split()
)
NUMBER = re.compile(r"[+\-−$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
MOST_BITS = 26  # of the bitmap
FEW = 64  # items that share a window that pairs are looked for by
# kinds of a word
IS_NUM, IS_CAP, IS_UNIT, DROPPED, ENDS, OPENS, ACRONYM = 1, 2, 4, 8, 16, 32, 64


class Words(dict):
    """Number of each raw word met; arrays of its hash, kind flags and value. Emptied by the caller when it grows."""

    def __init__(self):
        super().__init__()
        self.hash, self.low, self.flags, self.value = [], [], [], []

    def __missing__(self, w: str) -> int:
        core = EDGE.sub("", w)
        bare = w.strip("()[]{}\"'.,;:!?")
        flags = ENDS if w.rstrip("\"')]}»”").endswith((".", "!", "?", ":")) else 0
        if not core and bare not in UNITS:
            flags |= DROPPED
        elif m := NUMBER.match(core):
            rest = core[m.end() :].lower()
            flags |= IS_NUM if not rest or rest in UNITS else 0
        if bare.lower() in UNITS or core.lower() in UNITS:
            flags |= IS_UNIT
        text = core.lower() or bare
        if len(core) > 1 and core[0].isupper() and core[1:].islower():
            flags |= IS_CAP | OPENS * (text in OPENERS)
        elif 1 < len(core) < 6 and core.isupper():
            flags |= ACRONYM
        self.hash.append(xxhash.xxh64_intdigest(text.encode(), 1))
        self.flags.append(flags)
        self.value.append(text)
        self[w] = n = len(self)
        return n


MARKS = np.array([0, *(xxhash.xxh64_intdigest(x.encode(), 2) for x in (NUM, NAME, UNIT))], np.uint64)


def shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x moved by some places, False where nothing comes in."""
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by]
    else:
        out[:by] = x[-by:]
    return out


class Parsed:
    """Template words of some texts, one after another: hash, kind (0 plain, 1 number, 2 name, 3 unit), text, and the
    raw words from first up to after that a placeholder stands for."""

    def __init__(self, words: Words, ids, hashes, kind, text, first, after):
        self.words, self.ids, self.hashes, self.kind, self.text, self.first, self.after = words, ids, hashes, kind, text, first, after

    def slots(self, at: int, k: int) -> list[str]:
        """Values of the placeholders in a window."""
        return [" ".join(self.words.value[i] for i in self.ids[self.first[j] : self.after[j]]) for j in range(at, at + k) if self.kind[j]]

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash (as signed longs) of each window of k words inside one text."""
        h = rolled(self.hashes, k)
        at = np.flatnonzero(self.text[: len(h)] == self.text[k - 1 :])
        return at, h[at]


class Templates:
    """Parser; it remembers the words it met, `most_words` of them at most."""

    def __init__(self, most_words: int = 500_000):
        self.words, self.most, self.n = Words(), most_words, 0
        self.hash, self.flags = np.empty(0, np.uint64), np.empty(0, np.uint8)

    def parse(self, texts: list[str | None]) -> Parsed:
        if len(self.words) > self.most:
            self.__init__(self.most)
        number, parts = self.words.__getitem__, []
        for t in texts:
            raw = (t or "").split()
            parts.append(np.fromiter(map(number, raw), np.int32, len(raw)))
        if len(self.words.hash) != self.n:
            self.hash = np.concatenate([self.hash, np.array(self.words.hash[self.n :], np.uint64)])
            self.flags = np.concatenate([self.flags, np.array(self.words.flags[self.n :], np.uint8)])
            self.n = len(self.words.hash)
        ids, text = np.concatenate([np.empty(0, np.int32), *parts]), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        keep = self.flags[ids] & DROPPED == 0
        ids, text = ids[keep], text[keep]
        if not len(ids):
            return Parsed(self.words, ids, np.empty(0, np.uint64), np.empty(0, np.int8), text, ids, ids)
        f, same = self.flags[ids], np.append(False, text[1:] == text[:-1])  # same text as the word before
        opens = ~same | shifted(f & ENDS != 0, 1)
        num = f & IS_NUM != 0
        name = (f & IS_CAP != 0) & ~num & ~(opens & (f & OPENS != 0))
        behind = same & shifted(num, 1)  # next to a number
        between = behind & ~num & (name | (f & ACRONYM != 0))
        could = f & IS_UNIT != 0
        unit = could & ~num & (behind | (same & shifted(between, 1)))
        gone = between & ~unit & shifted(unit & same, -1)
        kind = np.where(num, 1, np.where(unit, 3, np.where(name, 2, 0))).astype(np.int8)
        left = np.flatnonzero(~gone)
        kind, now, same = kind[left], text[left], None
        new = np.append(True, (kind[1:] == 0) | (kind[1:] != kind[:-1]) | (now[1:] != now[:-1]))  # else part of the run before
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(left)) - 1
        kind, first, after = kind[starts], left[starts], left[ends] + 1
        hashes = np.where(kind > 0, MARKS[kind], self.hash[ids[first]])
        return Parsed(self.words, ids, hashes, kind, text[first], first, after)


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k words, as signed longs."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, (0x9E3779B97F4A7C15 + k) & ((1 << 64) - 1), np.uint64)
    for j in range(k):
        out ^= h[j : j + n]
        out *= np.uint64(0x100000001B3)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def covered(places: list[int], k: int) -> int:
    """Words under windows of k words at sorted places."""
    return sum(min(k, b - a) for a, b in zip(places, [*places[1:], places[-1] + k], strict=True))


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """(item_id, form, k, n, m, wpos, h, slots) of each item's windows, as it is and in lower case: m windows, with n
    words under them."""
    kind = items.schema["item_id"].dataType.simpleString()

    def each(batches):
        t = Templates()
        for b in batches:
            rows = []
            for item, text in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                seen = set()
                for form, x in enumerate((text, (text or "").lower())):
                    p = t.parse([x])
                    k = min(width, len(p.hashes))
                    if not k or p.hashes.tobytes() in seen:
                        continue
                    seen.add(p.hashes.tobytes())
                    _, hs = p.windows(k)
                    good = [i for i in range(len(hs)) if (p.kind[i : i + k] == 0).sum() >= min(2, k)] or list(range(len(hs)))
                    n = covered(good, k)
                    rows += [(item, form, k, n, len(good), i, int(hs[i]), p.slots(i, k)) for i in good]
            if rows:
                c = list(zip(*rows, strict=True))
                kinds = [b.schema.field(0).type, *[pa.int32()] * 5, pa.int64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in c[0]], kinds[0]), *(pa.array(x, y) for x, y in zip(c[1:], kinds[1:], strict=True))], ["item_id", "form", "k", "n", "m", "wpos", "h", "slots"])

    return items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(each, f"item_id {kind}, form int, k int, n int, m int, wpos int, h long, slots array<string>")


def bitmap(own: DataFrame) -> np.ndarray:
    """Bits of the windows' hashes: a power of two, 16 for each window, 2 ** MOST_BITS at most."""
    n = own.agg(F.approx_count_distinct("h")).first()[0]
    bits = min(MOST_BITS, max(16, (16 * n).bit_length()))
    words = np.zeros(1 << bits - 6, np.uint64)
    slot = F.col("h").bitwiseAND((1 << bits) - 1)
    for r in own.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).collect():  # 2 ** (MOST_BITS - 6) at most
        words[r.w] = np.uint64(r.bits & ((1 << 64) - 1))
    return words


def candidates(own: DataFrame, least: float) -> DataFrame:
    """own with column lead: whether pairs are looked for by the window. Windows of more than FEW items don't lead,
    if the words that are under none of them are so many that a document can't cover enough without one of the others."""
    df = own.groupBy("h").agg(F.count_distinct(F.struct("item_id")).alias("df"))
    rows = own.join(df, "h").withColumn("common", F.col("df") > FEW)
    place = F.sort_array(F.collect_set(F.when(F.col("common"), F.col("wpos"))))
    items = rows.groupBy("item_id", "form", "n", "k").agg(place.alias("place"))
    under = F.aggregate(F.zip_with("place", F.concat(F.slice("place", 2, 1 << 30), F.array(F.lit(1 << 30))), lambda a, b: F.least(F.col("k"), b - a)), F.lit(0), lambda s, x: s + x)
    items = items.select(F.struct("item_id", "form").alias("key"), ((F.col("n") - under) > (1 - least) * F.col("n")).alias("few"))
    rows = rows.withColumn("key", F.struct("item_id", "form")).join(items, "key").drop("key")
    return rows.withColumn("lead", ~(F.col("common") & F.col("few"))).drop("df", "common", "few")


def hits(docs: DataFrame, own: DataFrame) -> DataFrame:
    """(doc_id, pos, h, slots) of the documents' windows that the bitmap lets through."""
    lengths = sorted(r.k for r in own.select("k").distinct().collect())  # the width at most
    known = docs.sparkSession.sparkContext.broadcast(bitmap(own))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        t, words = Templates(), known.value
        mask = np.int64(len(words) * 64 - 1)

        def found(keys, texts, field):
            p = t.parse(texts)
            starts = np.searchsorted(p.text, np.arange(len(texts)))
            doc, pos, hs, values = [], [], [], []
            for k in lengths:
                at, w = p.windows(k)
                slot = w & mask
                for i in np.flatnonzero(words[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)):
                    j = int(at[i])
                    doc.append(keys[p.text[j]])
                    pos.append(j - int(starts[p.text[j]]))
                    hs.append(int(w[i]))
                    values.append(p.slots(j, k))
            return pa.RecordBatch.from_arrays([pa.array(doc, field.type), pa.array(pos, pa.int32()), pa.array(hs, pa.int64()), pa.array(values, pa.list_(pa.string()))], ["doc_id", "pos", "h", "slots"])

        for b in batches:
            keys, texts, held = [], [], 0
            for key, text in zip(b.column(0), b.column(1), strict=True):
                keys.append(key.as_py())
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held > 1 << 20:
                    yield found(keys, texts, b.schema.field(0))
                    keys, texts, held = [], [], 0
            if keys:
                yield found(keys, texts, b.schema.field(0))

    schema = f"doc_id {kind}, pos int, h long, slots array<string>"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(each, schema)


def findings(docs: DataFrame, items: DataFrame, width: int = 5, least: float = 0.8, drift: int = 16, share: float = 0.5) -> DataFrame:
    """(doc_id, item_id, coverage, other_slots) of each document and item that it holds."""
    own = cut(candidates(item_windows(items, width), least), "templates")
    found = cut(hits(docs, own).withColumn("doc", F.struct("doc_id")).drop("doc_id"), "hits")  # structs of nulls are equal
    of = own.withColumn("item", F.struct("item_id", "form")).drop("item_id", "form").withColumnRenamed("slots", "item_slots")
    pairs = found.join(of.where("lead").select("h", "item"), "h").select("doc", "item").distinct()
    hit = found.join(pairs, "doc").join(of.drop("lead"), ["h", "item"]).where(F.size("slots") == F.size("item_slots"))
    line = F.col("pos") - F.col("wpos")
    hit = hit.withColumn("line", F.explode(F.array(*[F.struct(F.lit(g).alias("grid"), F.floor((line + g * drift) / (2 * drift)).alias("at")) for g in (0, 1)])))
    hit = hit.groupBy("doc", "item", "n", "m", "k", "line").agg(
        F.sort_array(F.collect_set("wpos")).alias("place"),  # of one item: bounded by its length, like the pairs
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"),
    )
    words = F.aggregate(F.zip_with("place", F.concat(F.slice("place", 2, 1 << 30), F.array(F.lit(1 << 30))), lambda a, b: F.least(F.col("k"), b - a)), F.lit(0), lambda s, x: s + x)
    values = F.size(F.array_distinct(F.col("pairs.item_slots")))
    # values that stand for several ones are those that come in more than one pair
    clear = F.size(F.filter(F.array_distinct(F.col("pairs.item_slots")), lambda v: F.size(F.filter("pairs", lambda p: p.item_slots == v)) == 1))
    hit = hit.where(F.size("place") >= share * F.col("m")).withColumn("coverage", words / F.col("n")).where((F.col("coverage") >= least) & (clear >= least * values))
    hit = hit.withColumn("other", F.exists("pairs", lambda p: p.item_slots != p.slots))
    return hit.groupBy("doc.doc_id", "item.item_id").agg(F.max("coverage").alias("coverage"), F.bool_and("other").alias("other_slots"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, contaminated, item_ids, coverage, other_slots) for every row of docs."""
    found = findings(docs, items, width, least).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"), F.bool_and("other_slots").alias("other_slots"))
    found = cut(found, "leaks").withColumnRenamed("doc_id", "found")
    kind = items.schema["item_id"].dataType.simpleString()
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found")), "left").select("doc_id", F.col("coverage").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.array().cast(f"array<{kind}>")).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("other_slots", F.lit(False)).alias("other_slots"))


def keep_clean(docs: DataFrame, items: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark item."""
    found = cut(findings(docs, items, width, least).select(F.col("doc_id").alias("found")).distinct(), "leaks")
    return docs.join(found, docs.doc_id.eqNullSafe(found.found), "left_anti")
