"""N-gram scoring with an Elias-Fano trie (as in Pibiri and Venturini, 2017), cut into shards by context.

Learning counts every word and every pair of following words of all training documents; none is pruned.
Unigrams are smoothed by adding a half. A pair's probability is its discounted share of its context plus the
discount's mass times the second word's unigram (interpolated absolute discounting), so that each context's
probabilities sum to one.

Neither documents nor model are ever gathered. Documents are parsed once, into batches of about `at_once`
bytes that are written as a table: ids, word hashes, and the words' numbers in order. Each batch sends its
distinct words, with their training counts, to word shards, which sum the counts and answer them. It sends
its distinct pairs, with their training counts, to the shards of their contexts. A shard sums the counts,
builds its trie, writes it to the shared folder, maps it, looks up each distinct pair once, and answers one
code a pair; the batch adds the answers up by document. So training and scoring share one message. A context
with more than a shard's share of all tokens is split over as many shards as it has shares, by the hash of
the second word; such contexts are fewer than the shards, so their list is small whatever the input, and the
sums over a split context's parts are put together from it. The number of shards follows the number of tokens.
Messages number batches times shards.

A shard's trie has sorted word hashes; the contexts among them; monotone pointers into the pair level; and the
pair level itself, each context's successors as ranks raised by the last value before, so that the level is
monotone. All four are Elias-Fano sequences whose upper bits stay packed, with a directory of ones for each
512 bits. A pair is looked up among its context's successors, between two pointers. Discounted probabilities
and interpolation weights are 16-bit codes on a fixed grid, so that scores don't depend on the number of
shards. The levels are read in place from the mapped file (from bytes where the folder is no local one).

Defined cases: null and empty texts hold the end token alone. Null ids count as '' in the split. Repeated
rows count as often as they come and each comes back. Without training rows all counts are zero. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lean, open_path, remainder, shared_dir

BOS, END = xxhash.xxh64_intdigest(b" ", 0), xxhash.xxh64_intdigest(b"\n", 0)  # no word has a blank
DISCOUNT = 0.75
BLOCK = 8  # words of 64 bits in a directory entry
GRID = 2048  # codes for a factor of ten
U = np.uint64


def select_in_word(w: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) in each word."""
    place = np.zeros(len(w), np.int64)
    for wide in (32, 16, 8, 4, 2, 1):
        low = w & U((1 << wide) - 1)
        ones = np.bitwise_count(low).astype(np.int64)
        on = r >= ones
        r = np.where(on, r - ones, r)
        w = np.where(on, w >> U(wide), low)
        place += on * wide
    return place


class EliasFano:
    """Sorted unsigned numbers in about 2 + log2(universe / n) bits each, read in place."""

    def __init__(self, raw: bytes | memoryview, at: int = 0):
        self.n, self.low, self.top, low_bytes, blocks = struct.unpack_from("<5Q", raw, at)
        at += 40
        self.lows = np.ndarray((low_bytes - 7,), "<u8", raw, at, (1,))
        at += low_bytes
        self.highs = np.ndarray((blocks * BLOCK,), "<u8", raw, at)
        at += 8 * blocks * BLOCK
        self.ones = np.ndarray((blocks + 1,), "<i8", raw, at)  # before each block
        self.end = at + 8 * (blocks + 1)

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        n = len(values)
        top = int(values[-1]) if n else 0
        low = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        v = values.astype(U)
        high = (v >> U(low)).astype(np.int64)
        last = int(high[-1]) if n else 0
        blocks = (n + last + 1 + 64 * BLOCK) // (64 * BLOCK)
        bits = np.zeros(blocks * 64 * BLOCK, np.uint8)
        bits[high + np.arange(n)] = 1
        highs = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.append(0, np.cumsum(np.bitwise_count(highs).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)))
        lows = np.zeros((n * low >> 6) + 2, U)
        if low and n:
            part, at = v & U((1 << low) - 1), np.arange(n, dtype=np.int64) * low
            slot, shift = at >> 6, (at & 63).astype(U)
            starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            lows[slot[starts]] |= np.bitwise_or.reduceat(part << shift, starts)
            over = np.flatnonzero(shift + U(low) > U(64))  # one a word at most
            lows[slot[over] + 1] |= part[over] >> (U(64) - shift[over])
        packed = lows.astype("<u8").tobytes() + b"\0" * 8
        return struct.pack("<5Q", n, low, last, len(packed), blocks) + packed + highs.tobytes() + ones.astype("<i8").tobytes()

    def lower(self, i: np.ndarray) -> np.ndarray:
        at = i * self.low
        return (self.lows[at >> 3] >> (at & 7).astype(U)) & U((1 << self.low) - 1)

    def select(self, i: np.ndarray, zeros: bool = False) -> np.ndarray:
        """Place of the i-th one, or zero, of the upper bits."""
        before = np.arange(len(self.ones)) * (64 * BLOCK) - self.ones if zeros else self.ones
        block = np.searchsorted(before, i, "right") - 1
        words = self.highs[block[:, None] * BLOCK + np.arange(BLOCK)]
        if zeros:
            words = ~words
        sums = np.cumsum(np.bitwise_count(words).astype(np.int64), axis=1)
        rest = i - before[block]
        word = (sums <= rest[:, None]).sum(axis=1)
        rows = np.arange(len(i))
        rest = rest - np.where(word > 0, sums[rows, word - 1], 0)
        return (block * BLOCK + word) * 64 + select_in_word(words[rows, word], rest)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.select(i) - i).astype(U) << U(self.low) | self.lower(i)

    def all(self) -> np.ndarray:
        return self.get(np.arange(self.n)) if self.n else np.zeros(0, U)

    def find(self, values: np.ndarray, first: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
        """Index of each value, between first and after where they are given; -1 where it isn't there."""
        out = np.full(len(values), -1, np.int64)
        high = values.astype(U) >> U(self.low)
        rows = np.flatnonzero(high <= U(self.top)) if self.n else np.zeros(0, np.int64)
        h = high[rows].astype(np.int64)
        a, b = np.zeros(len(rows), np.int64), self.select(h, True) - h
        a[h > 0] = self.select(h[h > 0] - 1, True) - (h[h > 0] - 1)
        if first is not None:
            a, b = np.maximum(a, first[rows]), np.minimum(b, after[rows])
        want, end = values[rows].astype(U) & U((1 << self.low) - 1), b.copy()
        live = np.flatnonzero(a < b)
        while len(live):  # halve what has equal upper bits
            mid = (a[live] + b[live]) >> 1
            less = self.lower(mid) < want[live]
            a[live[less]] = mid[less] + 1
            b[live[~less]] = mid[~less]
            live = live[a[live] < b[live]]
        hit = np.flatnonzero(a < end)
        hit = hit[self.lower(a[hit]) == want[hit]]
        out[rows[hit]] = a[hit]
        return out


def coded(p: np.ndarray) -> np.ndarray:
    """Codes from 1 of numbers in (0, 1]: steps of a GRID-th of a factor of ten."""
    return (1 + np.minimum(np.rint(-np.log10(p) * GRID), 65534)).astype(np.uint16)


def decoded(code: np.ndarray, none: float) -> np.ndarray:
    """The numbers again; `none` for code 0."""
    return np.where(code > 0, 10.0 ** ((1 - code.astype(float)) / GRID), none)


class Trie:
    """Two levels: words, and the successors of those that are contexts, with a code each for
    the discounted share (successors) and the interpolation weight (contexts)."""

    def __init__(self, raw: bytes | memoryview):
        self.words = EliasFano(raw)
        self.contexts = EliasFano(raw, self.words.end)  # as ranks in words
        self.pointers = EliasFano(raw, self.contexts.end)
        self.successors = EliasFano(raw, self.pointers.end)
        at = self.successors.end
        self.weight = np.ndarray((self.contexts.n,), "<u2", raw, at)
        self.share = np.ndarray((self.successors.n,), "<u2", raw, at + 2 * self.contexts.n)

    @classmethod
    def open(cls, uri: str) -> Trie:
        """From a file: by memory mapping, or whole where the folder is no local one."""
        if uri.startswith(("file:", "/")):
            return cls(memoryview(np.memmap("/" + uri.removeprefix("file:").lstrip("/"), np.uint8, "r")))
        with open_path(uri, "rb") as f:
            return cls(f.read())

    @staticmethod
    def build(words: np.ndarray, first: np.ndarray, second: np.ndarray, pair: np.ndarray, totals: np.ndarray, discount: float = DISCOUNT) -> bytes:
        """From sorted word hashes and distinct pairs of places in them, sorted, with counts and their contexts' totals."""
        used = np.zeros(len(words), bool)
        used[first] = used[second] = True
        place = np.cumsum(used) - 1
        starts = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(first) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(first)) if len(first) else starts
        b = place[second]
        base = np.cumsum(b[ends - 1]) - b[ends - 1] if len(b) else b
        b += np.repeat(base, ends - starts)
        return b"".join(
            [EliasFano.pack(words[used]), EliasFano.pack(place[first[starts]].astype(U)), EliasFano.pack(np.append(starts, len(first)).astype(U)), EliasFano.pack(b.view(U))]
            + [coded(discount * (ends - starts) / totals[starts]).astype("<u2").tobytes(), coded((pair - discount) / totals).astype("<u2").tobytes()]
        )

    def look(self, words: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """words: distinct hashes; a, b: places in words. Codes: weight of each word as a context, share of each
        pair; 0 where training hasn't seen it."""
        rank, own = self.words.find(words), np.full(len(words), -1, np.int64)
        some = np.flatnonzero(rank >= 0)
        own[some] = self.contexts.find(rank[some].astype(U))
        seen = np.flatnonzero(own >= 0)
        lo, hi, base = np.zeros((3, len(words)), np.int64)
        lo[seen], hi[seen] = self.pointers.get(own[seen]).astype(np.int64), self.pointers.get(own[seen] + 1).astype(np.int64)
        later = seen[lo[seen] > 0]
        base[later] = self.successors.get(lo[later] - 1).astype(np.int64)
        weight, share = np.zeros(len(words), np.uint16), np.zeros(len(a), np.uint16)
        weight[seen] = self.weight[own[seen]]
        for k in range(0, len(a), at_once):
            ask = k + np.flatnonzero((own[a[k : k + at_once]] >= 0) & (rank[b[k : k + at_once]] >= 0))
            x = a[ask]
            at = self.successors.find((base[x] + rank[b[ask]]).astype(U), lo[x], hi[x])
            share[ask[at >= 0]] = self.share[at[at >= 0]]
        return weight, share


def planes(x: np.ndarray, kind: str) -> bytes:
    """Bytes of equal rank together: they pack better."""
    return np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(len(x), np.dtype(kind).itemsize).T.tobytes()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, each in the fewest bytes that hold them."""
    head, body = [struct.pack("<Q", len(arrays))], []
    for x in arrays:
        top = int(x.max()) if len(x) else 0
        kind = next(k for k in (1, 2, 4, 8) if top < 1 << 8 * k)
        head.append(struct.pack("<QQ", len(x), kind))
        body.append(planes(x, f"<u{kind}"))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpacked(raw: bytes | pa.Buffer) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    (n,) = struct.unpack_from("<Q", raw)
    at, out = 8 + 16 * n, []
    for i in range(n):
        size, kind = struct.unpack_from("<QQ", raw, 8 + 16 * i)
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, size * kind, at).reshape(kind, size).T).view(f"<u{kind}").reshape(size))
        at += size * kind
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of a sorted array, from zero."""
    return np.diff(x, prepend=x.dtype.type(0))


def batches(docs: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text", at_once: int = 6 << 20) -> DataFrame:
    """(batch, ids, body, trained, tokens): documents of about at_once bytes together. body: word hashes, the words'
    numbers in order, each document's number of words, and whether it trains; trained, tokens: number of
    training documents and their tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def each(rows):
        lean()
        base, digest = TaskContext.get().partitionId() << 36, xxhash.xxh64_intdigest
        ids, parts, fit, number, held = [], [], [], {}, 0

        def out(field):
            nonlocal base
            sizes, fit_now = np.array([len(p) for p in parts], np.int64), np.array(fit, np.int64)
            tokens = np.concatenate(parts)
            count = np.bincount(tokens, minlength=len(number))
            order = np.argsort(-count, kind="stable")  # frequent words get small numbers
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            hashes = np.fromiter((digest(w) for w in number), U, len(number))[order]
            body = packed(hashes, place[tokens], sizes, fit_now)
            got = pa.RecordBatch.from_arrays([pa.array([base], pa.int64()), pa.array([ids], pa.list_(field.type)), pa.array([body], pa.binary()), pa.array([int(fit_now.sum())], pa.int64()), pa.array([int(((sizes + 1) * fit_now).sum())], pa.int64())], ["batch", "ids", "body", "trained", "tokens"])
            base += 1
            for x in (ids, parts, fit, number):
                x.clear()
            return got

        for b in rows:
            for i, t, f in zip(*b.columns, strict=True):
                text = (t.as_py() or "").encode()
                words = text.lower().split()
                ids.append(i.as_py())
                parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
                fit.append(f.as_py())
                held += len(text) + 64
                if held >= at_once:
                    yield out(b.schema.field(0))
                    held = 0
            field = b.schema.field(0)
        if ids:
            yield out(field)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), F.col(train).cast("int")).mapInArrow(each, f"batch long, ids array<{kind}>, body binary, trained long, tokens long")


def split_words(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of words by shard and hash, and where each shard starts in it."""
    home = ((hashes >> U(40)) % U(shards)).astype(np.int64)
    order = np.lexsort((hashes, home))
    return order, np.searchsorted(home[order], np.arange(shards + 1))


class Pairs:
    """A batch's distinct pairs, by shard, context and second word; the same wherever they are made."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, shards: int, hot: tuple[np.ndarray, np.ndarray]):
        m = len(hashes) + 2
        hashes = np.append(hashes, np.array([BOS, END], U))
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        rank = np.empty(m, np.int64)
        rank[self.by_hash] = np.arange(m)
        ends = np.cumsum(sizes + 1)
        last, first = np.zeros(int(ends[-1]), bool), np.zeros(int(ends[-1]), bool)
        last[ends - 1] = True
        first[ends - 1 - sizes] = True
        self.second = np.full(len(last), m - 1, np.int32)  # END, as a word's number
        self.second[~last] = tokens
        before = np.full(len(last), m - 2, np.int32)
        before[~first] = tokens
        a, b = rank[before], rank[self.second]
        del before, first, last
        home, parts = (self.hashes >> U(40)) % U(shards), np.ones(m, U)
        if len(hot[0]):
            at = np.minimum(np.searchsorted(hot[0], self.hashes), len(hot[0]) - 1)
            parts = np.where(hot[0][at] == self.hashes, hot[1][at], parts)
        s = (self.hashes >> U(32))[b]
        s %= parts[a]
        s += home[a]
        s %= U(shards)
        s = s.view(np.int64)
        if shards * m * m < 1 << 62:
            s *= m
            s += a
            s *= m
            s += b
            del a, b
            order = np.argsort(s)
            s = s[order]
            new = np.append(True, s[1:] != s[:-1])
            key = s[new]
            self.b, key = (key % m).astype(np.int32), key // m
            self.a, s = (key % m).astype(np.int32), key // m
        else:
            order = np.lexsort((b, a, s))
            s, a, b = s[order], a[order], b[order]
            new = np.append(True, (s[1:] != s[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            s, self.a, self.b = s[new], a[new].astype(np.int32), b[new].astype(np.int32)
        self.of = np.empty(len(order), np.int32)  # pair of each token
        self.of[order] = np.cumsum(new, dtype=np.int32) - 1
        self.cuts = np.searchsorted(s, np.arange(shards + 1))
        self.parts = np.unique(s)

    def contexts(self, k: int) -> np.ndarray:
        """First pair of each context of a shard's pairs."""
        a = self.a[self.cuts[k] : self.cuts[k + 1]]
        return np.flatnonzero(np.append(True, a[1:] != a[:-1]))


def word_messages(held: DataFrame, shards: int) -> DataFrame:
    """(shard, batch, body): a batch's words of a shard, with their training counts."""

    def each(rows):
        lean()
        for r in rows:
            for batch, body in zip(r.column(0), r.column(1), strict=True):
                hashes, tokens, sizes, fit = unpacked(body.as_buffer())
                count = np.bincount(tokens[np.repeat(fit, sizes).astype(bool)], minlength=len(hashes))
                order, cuts = split_words(hashes, shards)
                some = np.flatnonzero(cuts[1:] > cuts[:-1])
                bodies = [packed(steps(hashes[order[cuts[k] : cuts[k + 1]]]), count[order[cuts[k] : cuts[k + 1]]]) for k in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([batch.as_py()] * len(some), pa.int64()), pa.array(bodies, pa.binary())], ["shard", "batch", "body"])

    return held.select("batch", "body").mapInArrow(each, "shard int, batch long, body binary")


def count_words(shards: int, total: int):
    """A shard's messages to answers: the training count of each word asked for. One more row, without a batch,
    has the shard's number of words that training saw, and those with more than a shard's share of all tokens."""

    def each(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lean()
        asked = [unpacked(x.as_buffer()) for x in rows.column("body")]
        words, back = np.unique(np.concatenate([np.cumsum(w, dtype=U) for w, _ in asked]), return_inverse=True)
        count = np.bincount(back, np.concatenate([c for _, c in asked])).astype(np.int64)
        ends = np.cumsum([len(w) for w, _ in asked])
        bodies = [packed(count[back[e - len(w) : e]]) for e, (w, _) in zip(ends, asked, strict=True)]
        hot = count * shards > total
        own = packed(np.array([np.count_nonzero(count)]), words[hot], count[hot])
        batch = pa.concat_arrays([rows.column("batch").combine_chunks(), pa.array([None], pa.int64())])
        return pa.table([batch, pa.array([key[0].as_py()] * len(batch), pa.int32()), pa.array([*bodies, own], pa.binary())], ["batch", "part", "body"])

    return each


def pair_messages(held: DataFrame, shards: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shard, batch, body): a batch's distinct pairs of a shard, with their training counts."""

    def each(rows):
        lean()
        for r in rows:
            for batch, body in zip(r.column(0), r.column(1), strict=True):
                hashes, tokens, sizes, fit = unpacked(body.as_buffer())
                sizes = sizes.astype(np.int64)
                p = Pairs(hashes, tokens, sizes, shards, hot)
                n = np.bincount(p.of, np.repeat(fit, sizes + 1), len(p.a)).astype(np.int64)
                place, bodies = np.zeros(len(p.hashes), np.int64), []
                for k in p.parts.tolist():
                    own = slice(p.cuts[k], p.cuts[k + 1])
                    used = np.unique(np.concatenate([p.a[own], p.b[own]]))
                    place[used] = np.arange(len(used))
                    bodies.append(packed(steps(p.hashes[used]), steps(place[p.a[own]]), place[p.b[own]], n[own]))
                yield pa.RecordBatch.from_arrays([pa.array(p.parts, pa.int32()), pa.array([batch.as_py()] * len(bodies), pa.int64()), pa.array(bodies, pa.binary())], ["shard", "batch", "body"])

    return held.select("batch", "body").mapInArrow(each, "shard int, batch long, body binary")


def serve(hot: tuple[np.ndarray, np.ndarray, np.ndarray], folder: str):
    """A shard's messages to answers: share codes of the pairs asked for, and weight codes of their contexts.
    One more row, without a batch, has the number of kinds of successors of the split contexts here.
    hot: hashes, parts and counts of split contexts."""

    def each(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lean()
        words, a, b, n, contexts, at = [], [], [], [], [], 0
        for x in rows.column("body"):
            w, da, y, times = unpacked(x.as_buffer())
            words.append(np.cumsum(w, dtype=U))
            a.append(np.cumsum(da, dtype=np.int32) + np.int32(at))
            b.append(y.astype(np.int32) + np.int32(at))
            contexts.append(a[-1][np.append(True, a[-1][1:] != a[-1][:-1])])
            n.append(times.astype(np.int32))
            at += len(w)
        ends = np.cumsum([len(x) for x in a])
        words, place = np.unique(np.concatenate(words), return_inverse=True)
        pair = place[np.concatenate(a)]
        pair <<= 32
        pair |= place[np.concatenate(b)]
        del a, b
        order = np.argsort(pair, kind="stable")  # sorted runs, one a message
        pair, n = pair[order], np.concatenate(n)[order]
        new = np.append(True, pair[1:] != pair[:-1])
        of = np.empty(len(order), np.int32)
        of[order] = np.cumsum(new, dtype=np.int32) - 1
        del order
        count = np.add.reduceat(n, np.flatnonzero(new), dtype=np.int64)
        pair = pair[new]
        first, second = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
        del pair, n, new
        seen = np.flatnonzero(count)
        totals, kinds = np.bincount(first, count, len(words)), np.bincount(first[seen], minlength=len(words))
        split = np.isin(words, hot[0])
        totals[split] = hot[2][np.searchsorted(hot[0], words[split])]
        here = np.flatnonzero(split & (kinds > 0))
        uri = f"{folder}/{key[0].as_py()}-{uuid.uuid4().hex}.trie"
        with open_path(uri, "wb") as f:
            f.write(Trie.build(words, first[seen], second[seen], count[seen], totals[first[seen]]))
        weight, share = Trie.open(uri).look(words, first, second)
        bodies = [packed(share[of[lo:hi]], weight[place[x]]) for lo, hi, x in zip([0, *ends[:-1]], ends, contexts, strict=True)]
        own = packed(words[here], kinds[here])
        batch = pa.concat_arrays([rows.column("batch").combine_chunks(), pa.array([None], pa.int64())])
        return pa.table([batch, pa.array([key[0].as_py()] * len(batch), pa.int32()), pa.array([*bodies, own], pa.binary())], ["batch", "part", "body"])

    return each


def finish(shards: int, hot: tuple[np.ndarray, np.ndarray, np.ndarray], weights: np.ndarray, total: int, distinct: int, docs_seen: int):
    """A batch and its answers to a row for each document. weights: interpolation weights of the split contexts."""
    norm = total + 0.5 * (distinct + 1)

    def each(key: tuple[pa.Scalar, ...], batch: pa.Table, answers: pa.Table) -> pa.Table:
        lean()
        ids = batch.column("ids")[0].values
        hashes, tokens, sizes, _ = unpacked(batch.column("body")[0].as_buffer())
        sizes = sizes.astype(np.int64)
        by = {(p, k): unpacked(x.as_buffer()) for p, k, x in zip(answers.column("pairs").to_pylist(), answers.column("part").to_pylist(), answers.column("body"), strict=True)}
        count = np.zeros(len(hashes) + 2)
        order, cuts = split_words(hashes, shards)
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            count[order[cuts[k] : cuts[k + 1]]] = by[False, k][0]
        count[-1] = docs_seen  # END
        p = Pairs(hashes, tokens, sizes, shards, hot[:2])
        uni = (count + 0.5) / norm
        prob = np.empty(len(p.a))
        for k in p.parts.tolist():
            lo, hi = p.cuts[k], p.cuts[k + 1]
            share, weight = by[True, k]
            starts = p.contexts(k)
            weight = decoded(weight, 1.0)
            if len(hot[0]):
                h = p.hashes[p.a[lo + starts]]
                at = np.minimum(np.searchsorted(hot[0], h), len(hot[0]) - 1)
                weight = np.where(hot[0][at] == h, weights[at], weight)
            prob[lo:hi] = decoded(share, 0.0) + np.repeat(weight, np.diff(np.append(starts, hi - lo))) * uni[p.by_hash[p.b[lo:hi]]]
        starts = np.cumsum(sizes + 1) - sizes - 1
        c = count[p.second]
        sums = [np.add.reduceat(x, starts) for x in (np.log10(c + 0.5), np.log10(prob)[p.of], (c > 0).astype(np.int64))]
        return pa.table([ids, pa.array(sizes + 1), pa.array(sums[2]), pa.array(sums[0] - (sizes + 1) * np.log10(norm)), pa.array(sums[1])], ["id", "n_tokens", "n_known", "base_score", "score"])

    return each


def score(docs: DataFrame, by: int = 5, held: int = 1, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 2_500_000, at_once: int = 6 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    flag = "train" if id_col != "train" and text_col != "train" else "train_"
    rows = docs.select(id_col, text_col, (remainder(id_col, by) != held).alias(flag))
    batch = cut(batches(rows, flag, id_col, text_col, at_once), "lm-batches")
    total, docs_seen = (int(x) for x in batch.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0))).first())
    shards = shards or max(6, -(-total // shard_tokens))

    asked = word_messages(batch, shards).repartition(shards, "shard")
    words = cut(asked.groupBy("shard").applyInArrow(count_words(shards, total), "batch long, part int, body binary"), "lm-words")
    own = [unpacked(r.body) for r in words.where("batch is null").select("body").collect()]  # a row a shard, fewer than `shards` words in all
    seen = sum(int(x[0][0]) for x in own)
    distinct = seen + int(docs_seen > 0)
    hashes, counts = (np.concatenate([np.zeros(0, t), *(x[i].astype(t) for x in own)]) for i, t in ((1, U), (2, np.int64)))
    if docs_seen * shards > total:
        hashes, counts = np.append(hashes, U(BOS)), np.append(counts, docs_seen)
    at = np.argsort(hashes)
    hashes, counts = hashes[at], counts[at]
    hot = hashes, np.ceil(counts * shards / max(1, total)).astype(U), counts

    asked = pair_messages(batch, shards, hot[:2]).repartition(shards, "shard")
    folder = f"{shared_dir(spark)}/lm-model-{uuid.uuid4().hex}"
    pairs = cut(asked.groupBy("shard").applyInArrow(serve(hot, folder), "batch long, part int, body binary"), "lm-pairs")
    kinds = np.zeros(len(hashes))
    for r in pairs.where("batch is null").select("body").collect():  # a row a shard, of its parts of split contexts
        w, k = unpacked(r.body)
        np.add.at(kinds, np.searchsorted(hashes, w), k)
    weights = np.where(kinds > 0, DISCOUNT * kinds / np.maximum(counts, 1), 1.0)

    answers = words.where("batch is not null").withColumn("pairs", F.lit(False)).unionByName(pairs.where("batch is not null").withColumn("pairs", F.lit(True)))
    out = batch.select("batch", "ids", "body").groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish(shards, hot, weights, total, distinct, docs_seen), f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    out = out.withColumnRenamed("id", id_col)
    return cut(out.select(id_col, (remainder(id_col, by) == held).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"), "lm")
