"""SimHash near-duplicates (Charikar 2002; blocks as in Manku et al. 2007).

A fingerprint has 64 bits, a bit set where over half of the text's three-word shingles set it
in their XXH64. Texts link at `radius` or fewer differing bits; classes are the connected
components of the links.

Comparison is exact and tiled. A grid over all fingerprints would be quadratic, so tiles are cut
inside blocks: of radius + 1 equal slices of the 64 bits, two linked fingerprints share one at
least, so the fingerprints that share a slice are compared and no link is lost. A block larger
than `tile` rows is cut into tiles by population count and a salt; a pair of tiles is a unit of
work of its own, and pairs whose population counts differ by more than the radius are never sent.
Inside a unit numpy compares sorted runs by exclusive-or and bit counts, again skipping runs that
differ too much in population count, and yields a spanning forest of the links, not all pairs.

Defined cases: null and empty texts have fingerprint zero and link like any other. Equal
fingerprints are one class. Repeated rows each come back. A null doc_id gets the class's smallest
non-null id, null if there is none. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut

SEED = 42
PART = 1 << 16  # shingles whose bits are counted at once
SALTS = 8  # parts that rows of one key are dealt to
WIDE = 8  # words of a fingerprint in similar_classes


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join, seed = xxhash.xxh64_intdigest, b" ".join, SEED
    n, counts = len(words) - width + 1, np.zeros(64, np.int64)
    for at in range(0, n, PART):
        m = min(PART, n - at)
        runs = zip(*(words[at + k : at + k + m] for k in range(width)), strict=True)
        h = np.fromiter((digest(join(x), seed) for x in runs), np.uint64, m)
        counts += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""

    def each(batches):
        for b in batches:
            got = np.array([fingerprint(x.as_py(), width) for x in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, f"id {kind}, fp long")


def joined(n: int, pairs) -> np.ndarray:
    """Smallest row of each of n rows' class, under pairs (i, j) of arrays."""
    lab = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = lab[i], lab[j]
            if not (odd := a != b).any():
                break
            i, j, a, b = i[odd], j[odd], a[odd], b[odd]
            np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
            while (up := lab[lab]).tobytes() != lab.tobytes():
                lab[:] = up
    return lab


def close_pairs(unit: np.ndarray, fp: np.ndarray, radius: int, size: np.ndarray | None, least: float, tile: int):
    """Pairs (i, j) of rows of one unit whose fingerprints (rows, words) differ in `radius` bits at most and whose sizes
    allow a similarity of `least`. Rows are sorted by unit and population count; what differs more in that is skipped."""
    n, words = fp.shape
    pc = np.bitwise_count(fp).sum(axis=1, dtype=np.int16)
    ends = np.flatnonzero(np.append(unit[1:] != unit[:-1], True)) + 1
    starts = np.append(0, ends[:-1])
    end, small = np.repeat(ends, ends - starts), (np.repeat(ends - starts, ends - starts)) <= 128
    rows, k, found = np.flatnonzero(small), 1, []
    while len(rows):
        rows = rows[rows + k < end[rows]]
        rows = rows[pc[rows + k] - pc[rows] <= radius]  # later ones differ even more
        near = rows
        if size is not None:
            near = near[np.minimum(size[near], size[near + k]) >= least * np.maximum(size[near], size[near + k])]
        d = np.bitwise_count(fp[near] ^ fp[near + k])
        hit = near[(d[:, 0] if words == 1 else d.sum(axis=1, dtype=np.int16)) <= radius]
        if len(hit):
            found.append((hit, hit + k))
        k += 1
    if found:
        yield np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    for lo, hi in zip(starts, ends, strict=True):
        if hi - lo <= 128:
            continue
        for a in range(lo, hi, tile):
            last = min(a + tile, hi)
            for b in range(a, hi, tile):
                if pc[b] - pc[last - 1] > radius:
                    break
                to = min(b + tile, hi)
                d = np.bitwise_count(fp[a:last, :1] ^ fp[None, b:to, 0]).astype(np.int16)
                for w in range(1, words):
                    d += np.bitwise_count(fp[a:last, w, None] ^ fp[None, b:to, w])
                good = d <= radius
                if size is not None:
                    x, y = size[a:last, None], size[None, b:to]
                    good &= np.minimum(x, y) >= least * np.maximum(x, y)
                i, j = np.nonzero(good)
                yield i + a, j + b


def forest(unit: np.ndarray, fp: np.ndarray, radius: int, size: np.ndarray | None = None, least: float = 0.0, tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by (unit, population count). Spanning edges (row, smallest row of its class) of the
    links inside each unit, see close_pairs."""
    lab = joined(len(fp), close_pairs(unit, fp.reshape(len(fp), -1), radius, size, least, tile))
    tied = np.flatnonzero(lab != np.arange(len(fp)))
    return tied, lab[tied]


def in_units(rows: DataFrame, radius: int, tile: int, key: str) -> DataFrame:
    """rows (block, pc, ...) with a column unit in place of block: the block, or each pair of tiles of it that a row
    takes part in where the block has more than `tile` rows. Tiles are cut by population count and the key's hash."""
    tiles = rows.groupBy("block", "pc").count().groupBy("block").agg(F.sum("count").alias("m"), F.map_from_entries(F.collect_list(F.struct("pc", F.ceil(F.col("count") / tile).cast("int")))).alias("tiles"))
    tiles = tiles.where(F.col("m") > tile).select("block", "tiles")  # one entry for each population count of a block
    own = f"pc * 100000L + pmod(xxhash64({key}, 7), tiles[pc])"
    pairs = f"""transform(flatten(transform(filter(sequence(pc - {radius}, pc + {radius}), p -> tiles[p] is not null),
        p -> transform(sequence(0, tiles[p] - 1), s -> p * 100000L + s))), t -> xxhash64(block, least(t, {own}), greatest(t, {own})))"""
    rest = [c for c in rows.columns if c != "block"]
    return rows.join(tiles, "block", "left").selectExpr(f"explode(case when tiles is null then array(block) else {pairs} end) unit", *rest)


def unit_by_unit(judge):
    """Function for mapInArrow over rows that are sorted by their first column, unit: judge gets the columns of
    whole units, as arrays, and returns columns a and b. One unfinished unit, of two tiles at most, is held."""

    def each(batches):
        kept = None
        for b in batches:
            cols = [y.to_numpy(zero_copy_only=False) for y in b.columns]
            if kept is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(kept, cols, strict=True)]
            unit = cols[0]
            if len(unit) and len(whole := np.flatnonzero(unit != unit[-1])):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in judge(*(c[: whole[-1] + 1] for c in cols))], ["a", "b"])
                cols = [c[whole[-1] + 1 :] for c in cols]
            kept = cols
        if kept is not None and len(kept[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in judge(*kept)], ["a", "b"])

    return each


def links(fps: DataFrame, radius: int = 3, tile: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that keep every class of links together."""
    n, wide = radius + 1, 64 // (radius + 1)
    slices = [F.struct(F.lit(k).alias("k"), F.shiftrightunsigned("fp", k * wide).bitwiseAND((1 << wide if k < n - 1 else 1 << (64 - k * wide)) - 1).alias("v")) for k in range(n)]
    rows = fps.select("fp", F.bit_count("fp").alias("pc"), F.explode(F.array(*slices)).alias("s")).select("fp", "pc", (F.col("s.v") * n + F.col("s.k")).alias("block"))

    def judge(unit, fp):
        i, j = forest(unit, fp.view(np.uint64), radius)
        return fp[i], fp[j]

    return in_units(rows, radius, tile, "fp").repartition("unit").sortWithinPartitions("unit", "pc").select("unit", "fp").mapInArrow(unit_by_unit(judge), "a long, b long")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, tile: int = 4096) -> DataFrame:
    """(id, fp, component_id) for every row of docs."""
    fps = cut(fingerprints(docs, id_col, text_col, width), "simhash")
    own = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    roots = components(links(own.select("fp"), radius, tile))
    own = own.join(roots, own.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    ids = own.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(own.join(ids, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def hex16(c: str):
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def kept(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of docs, with all its columns, of each class (id, t, component): the one with the smallest id, null
    last, then with the smallest t, the text's hash. Rows that repeat it come once."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("t"))).alias("x")
    best = classes.groupBy("component").agg(first).select("x.id", "x.t")
    # join and aggregate share one key, so texts are shuffled once; structs of nulls are equal, and the salt splits an id of many rows
    key = "key"
    while key in map(str.lower, docs.columns):
        key += "_"
    best = cut(best, "kept").select(F.struct("id", "t").alias(key))
    rows = docs.withColumn(key, F.struct(F.col(id_col).alias("id"), text_hash(text_col).alias("t")))
    return rows.join(best, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """One row of each class of simhash_classes, see kept."""
    t = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("t"), F.col(text_col).alias("text"))
    fps = cut(t.select(F.struct("id", "t").alias("id"), "text").transform(lambda d: fingerprints(d, "id", "text", width)), "simhash")
    roots = components(links(fps.select("fp").distinct(), radius))
    return kept(docs, fps.join(roots, fps.fp == roots.node, "left").select("id.id", "id.t", F.coalesce("root", "fp").alias("component")), id_col, text_col)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; of all words where there are fewer."""
    words = (text or "").encode().lower().split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest, join, seed = xxhash.xxh64_intdigest, b" ".join, SEED
    runs = zip(*(words[k : len(words) - width + 1 + k] for k in range(width)), strict=True)
    return np.unique(np.fromiter((digest(join(x), seed) for x in runs), np.uint64, len(words) - width + 1))


def band_hashes(h: np.ndarray, odd: np.ndarray, mask: np.ndarray, rows: int) -> np.ndarray:
    """One hash of each band of `rows` least values under the permutations (h ^ mask) * odd."""
    least = np.full(len(odd), np.iinfo(np.uint64).max)
    for at in range(0, len(h), 256):
        np.minimum(least, ((h[at : at + 256, None] ^ mask) * odd).min(axis=0), out=least)
    out = np.arange(len(odd) // rows, dtype=np.uint64)
    for x in least.reshape(-1, rows).T:
        out = (out ^ x) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def wide_fingerprint(h: np.ndarray, words: int = WIDE) -> np.ndarray:
    """Fingerprint of 64 * words bits of a set of hashes: bits set in over half of each member's mixes."""
    out = np.empty(words, np.uint64)
    for k in range(words):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(h), PART):
            x = (h[at : at + PART] ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
            x ^= x >> np.uint64(33)
            x *= np.uint64(0xC4CEB9FE1A85EC53)
            x ^= x >> np.uint64(33)
            counts += np.unpackbits(x.view(np.uint8).reshape(len(x), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        out[k] = np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0]
    return out


def radius_for(least: float, bits: int) -> int:
    """Bits in which fingerprints of sets with a Jaccard similarity of `least` differ at most, but for 4.5
    deviations. A bit differs with probability angle / pi, which few members raise by a quarter at most."""
    p = math.acos(2 * least / (1 + least)) / math.pi * 1.1
    few = p * 1.14  # sets of five or six members
    return math.ceil(bits * few + 4.5 * math.sqrt(bits * p * (1 - p)))


def by_hash(rows: DataFrame, weight, tile: int, key: str = "t", block: str = "block") -> DataFrame:
    """rows with a column unit in place of `block`: the block, or each pair of tiles that a row takes part in where
    the block weighs more than `tile`. Tiles are cut by the key's hash; rows of a heavy block meet its number of tiles
    in several tasks."""
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4 * SALTS - 1).cast("long"))).alias("salt")
    heavy = rows.groupBy(block).agg(F.ceil(F.sum(weight) / tile).cast("int").alias("tiles")).where("tiles > 1").select(block, "tiles", salts)
    own = f"pmod(xxhash64({key}, 7), tiles)"
    units = f"explode(case when tiles is null then array({block}) else transform(sequence(0, tiles - 1), k -> xxhash64({block}, least(k, {own}), greatest(k, {own}))) end) unit"
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(4 * SALTS)))
    return salted.join(heavy, [block, "salt"], "left").selectExpr(units, *[c for c in rows.columns if c != block])


def exact_links(sets: list[np.ndarray], least: float, at_once: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (i, smallest row of its class) of the sorted sets with a Jaccard similarity of `least` or more."""
    n, size = len(sets), np.array([len(x) for x in sets])
    if n <= 16:
        pairs = []
        for i in range(n):
            for j in range(i + 1, n):
                if min(size[i], size[j]) >= least * max(size[i], size[j]):
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if common >= least * (size[i] + size[j] - common):
                        pairs.append((i, j))
        pairs = [tuple(np.array(x) for x in zip(*pairs, strict=True))] if pairs else []
    else:
        member, row = np.unique(np.concatenate(sets), return_inverse=True)[1], np.repeat(np.arange(n), size)
        shared = np.bincount(member) > 1
        place = np.cumsum(shared) - 1
        keep = shared[member]
        member, row = place[member[keep]], row[keep]
        order = np.argsort(member, kind="stable")
        member, row = member[order], row[order]
        common, wide = np.zeros((n, n), np.float32), max(1, at_once // n)
        for lo in range(0, int(shared.sum()), wide):  # some members at a time: counts of common ones as a product
            a, b = np.searchsorted(member, (lo, lo + wide))
            m = np.zeros((n, wide), np.float32)
            m[row[a:b], member[a:b] - lo] = 1
            common += m @ m.T
        good = common >= least * (size[:, None] + size[None] - common) - 1e-3
        for i, j in zip(*np.nonzero(np.triu(good, 1) & (common < least * (size[:, None] + size[None] - common) + 1e-3)), strict=True):  # at the threshold: in whole numbers
            c = int(common[i, j])
            good[i, j] = c >= least * (size[i] + size[j] - c)
        pairs = [np.nonzero(np.triu(good, 1))]
    lab = joined(n, pairs)
    tied = np.flatnonzero(lab != np.arange(n))
    return tied, lab[tied]


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8, bands: int = 48, rows: int = 6, tile: int = 4096, members: int = 1 << 17) -> DataFrame:
    """(id, t, component) for every row of docs: connected components of the texts whose sets of `width`-word
    shingles have a Jaccard similarity of `least` or more; t is the text's hash.

    Blocks are texts that share one of `bands` bands of `rows` MinHash values (at 0.8 a pair is missed with
    probability (1 - 0.8 ** 6) ** 48, below 1e-6). Inside a block fingerprints of 512 bits are compared tile by
    tile with a radius that holds all similar pairs, which yields a spanning forest of the candidates. The texts that
    these join are a cluster; inside it sets are compared exactly, which yields a spanning forest of the links. So
    no group's pairs are emitted. Blocks above `tile` texts, and clusters above `members` shingles, are cut into
    pairs of tiles."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("t", F.xxhash64("text"))
    names, radius = [f"f{k}" for k in range(WIDE)], radius_for(least, 64 * WIDE)

    def signed(batches):
        r = np.random.default_rng(SEED)
        odd, mask = r.integers(0, 1 << 64, (2, bands * rows), np.uint64)
        odd |= np.uint64(1)
        for b in batches:
            got, size, fps = [], [], []
            for x in b.column(2):
                h = shingles(x.as_py(), width)
                got.append(band_hashes(h, odd, mask, rows).view(np.int64))
                fps.append(wide_fingerprint(h))
                size.append(len(h))
            fps = np.array(fps, np.uint64).reshape(len(size), WIDE).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.list_(pa.int64())), pa.array(size, pa.int64()), *(pa.array(np.ascontiguousarray(fps[:, k])) for k in range(WIDE))], ["id", "t", "bands", "size", *names])

    seen = cut(base.select("id", "t", "text").mapInArrow(signed, f"id {kind}, t long, bands array<long>, size long, {', '.join(f'{c} long' for c in names)}"), "similar")
    own = seen.groupBy("t").agg(F.any_value("bands").alias("bands"), F.any_value("size").alias("size"), *(F.any_value(c).alias(c) for c in names))
    spread = own.select("t", F.explode("bands").alias("block"))
    shared = spread.groupBy("block").agg(F.min("t").alias("first"), F.max("t").alias("last")).where("first <> last").select("block")
    spread = cut(spread.join(shared, "block"), "blocks")
    prints = own.select("t", "size", *names).withColumn("pc", sum((F.bit_count(c) for c in names), F.lit(0)).cast("int"))

    def judge(unit, t, size, *fp):
        i, j = forest(unit, np.stack(fp, axis=1).view(np.uint64), radius, size, least)
        return t[i], t[j]

    units = by_hash(spread.join(prints, "t"), F.lit(1), tile).repartition("unit").sortWithinPartitions("unit", "pc")
    clusters = components(units.select("unit", "t", "size", *names).mapInArrow(unit_by_unit(judge), "a long, b long"))

    def sets(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([shingles(x.as_py(), width).view(np.int64) for x in b.column(3)], pa.list_(pa.int64()))], ["t", "block", "size", "h"])

    def exact(batches):
        def links_in(rows: pa.Table, ends: list[int]):
            t, h = rows.column(1).to_numpy(), rows.column(2).combine_chunks()
            offsets, values, out = h.offsets.to_numpy(), h.values.to_numpy().view(np.uint64), ([], [])
            for x, y in zip([0, *ends[:-1]], ends, strict=True):
                i, j = exact_links([values[offsets[k] : offsets[k + 1]] for k in range(x, y)], least)
                out[0].append(t[x:y][i])
                out[1].append(t[x:y][j])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], ["a", "b"])

        held = None  # one unfinished unit
        for b in batches:
            rows = pa.table(b.columns, names=["unit", "t", "h"])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            unit = rows.column(0).to_numpy()
            ends = (np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist()
            if ends:
                yield links_in(rows, ends)
            held = rows.slice(ends[-1] if ends else 0)
        if held is not None and len(held):
            yield links_in(held.combine_chunks(), [len(held)])

    clusters = cut(clusters.select(F.col("node").alias("t"), F.col("root").alias("block")), "clusters")
    texts = base.select("t", "text").join(clusters, "t").groupBy("t", "block").agg(F.any_value("text").alias("text"))
    sized = texts.withColumn("size", F.length("text").cast("long")).select("t", "block", "size", "text").mapInArrow(sets, "t long, block long, size long, h array<long>")
    sized = cut(sized.withColumn("size", F.size("h").cast("long")), "shingles")
    units = by_hash(sized, "size", members).repartition("unit").sortWithinPartitions("unit").select("unit", "t", "h")
    roots = components(units.mapInArrow(exact, "a long, b long"))
    return seen.select("id", "t").join(roots, F.col("t") == F.col("node"), "left").select("id", "t", F.coalesce("root", "t").alias("component"))


def keep_dissimilar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """One row of each class of similar_classes, see kept."""
    return kept(docs, similar_classes(docs, id_col, text_col, width, least), id_col, text_col)
