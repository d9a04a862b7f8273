"""AVI motion-JPEG: writer, RIFF parser, baseline JPEG decoder in numpy, shots by histogram differences.

A payload of bytes is stored without loss as the blocks of grey baseline JPEG frames: one frame holds
192 bytes as 16 by 12 blocks, each a flat 8 by 8 square whose grey is the byte (its DC coefficient,
with quantiser 8, is the byte less 128). Any motion-JPEG player shows these frames. Frames leave out
the Huffman tables, as AVI files do, and mean the usual ones.

The decoder takes baseline frames of one to three components with any sampling factors, with or without restart
markers; it decodes
the frames of a batch in step, one Huffman symbol of each at a time, so that numpy works on thousands
of frames at once. Shots: histograms of the frames' block greys, their successive differences, and a
cut where a difference exceeds both `floor` and the mean plus `k` deviations of those around it.

Defined cases: a null or empty text is one frame of blanks. Null ids and repeated rows come back, and
equal texts give equal values. A file that isn't RIFF AVI or has no video stream, or a frame that isn't
baseline JPEG, is an error, not skipped. An empty table gives an empty result. Other columns are not read. Long texts are
coded and decoded a bounded number of frames at a time.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT, WIDE, HIGH = 192, 16, 12  # bytes and blocks of a frame
FPS = 25
AT_ONCE, CODED = 1 << 10, 1 << 8  # frames decoded and coded together: their arrays stay in the cache

# fixed values: the usual Huffman tables (ITU-T T.81, Annex K), counts of codes by length, then symbols
DC_BITS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_BITS_C = (0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0)
DC_VALUES = tuple(range(12))
AC_BITS = (0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125)
AC_FIRST = "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282"
AC_BITS_C = (0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119)
AC_FIRST_C = "000102031104052131061241510761711322328108144291a1b1c109233352f0156272d10a162434e125f1"


def ac_values(first: str) -> tuple[int, ...]:
    """The symbols with short codes, then all others of run 0-15 and size 1-10 in order."""
    head = list(bytes.fromhex(first))
    rest = [r << 4 | s for r in range(16) for s in range(1, 11)]
    return (*head, *(x for x in rest if x not in head))


def zigzag() -> np.ndarray:
    order = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    return np.array([y * 8 + x for y, x in order])


ZIGZAG = zigzag()
DCT = np.array([[(0.5 if u else 0.125**0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])


def codes(bits: tuple[int, ...], values: tuple[int, ...]) -> dict[int, tuple[int, int]]:
    """Symbol: (code, length)."""
    out, code, k = {}, 0, 0
    for length, n in enumerate(bits, 1):
        for _ in range(n):
            out[values[k]] = (code, length)
            code, k = code + 1, k + 1
        code <<= 1
    return out


def lookup(bits: tuple[int, ...], values: tuple[int, ...]) -> np.ndarray:
    """For each 16 bits ahead: length << 8 | symbol, 0 where no code fits."""
    out = np.zeros(1 << 16, np.int32)
    for symbol, (code, length) in codes(bits, values).items():
        out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return out


DEFAULTS = {(0, 0): (DC_BITS, DC_VALUES), (0, 1): (DC_BITS_C, DC_VALUES), (1, 0): (AC_BITS, ac_values(AC_FIRST)), (1, 1): (AC_BITS_C, ac_values(AC_FIRST_C))}


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


def flat_lookup(dc: np.ndarray, ac: np.ndarray, ahead: int = 18) -> np.ndarray:
    """For each 18 bits ahead that hold a whole block without AC: difference + 2048 << 8 | length, else 0."""
    x = np.arange(1 << ahead)
    n, s = dc[x >> 2] >> 8, dc[x >> 2] & 255
    fits = (n > 0) & (n + s < ahead)
    n, s = np.where(fits, n, 0), np.where(fits, s, 0)
    bits = (x << n & (1 << ahead) - 1) >> (ahead - s)
    diff = np.where(s > 0, np.where(bits < (1 << np.maximum(s - 1, 0)), bits - (1 << s) + 1, bits), 0)
    end = ac[(x << (n + s) & (1 << ahead) - 1) >> 2]
    total = n + s + (end >> 8)
    return np.where(fits & (end > 0) & (end & 255 == 0) & (total <= ahead), (diff + 2048) << 8 | total, 0).astype(np.int32)


HEAD = b"\xff\xd8" + segment(0xDB, bytes([0, 8, *[1] * 63])) + segment(0xC0, struct.pack(">BHHBBBB", 8, HIGH * 8, WIDE * 8, 1, 1, 0x11, 0)) + segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))
END = b"\xff\xd9"
RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def diff_table() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each difference -255..255: DC code, magnitude, end of block."""
    dc, (eob, eob_n) = codes(DC_BITS, DC_VALUES), codes(AC_BITS, ac_values(AC_FIRST))[0]
    word, size = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        code, n = dc[s]
        word[d + 255] = ((code << s | (d if d > 0 else d + (1 << s) - 1)) << eob_n | eob) if s else (code << eob_n | eob)
        size[d + 255] = n + s + eob_n
    return word, size


def encode_frames(payload: np.ndarray) -> list[bytes]:
    """A JPEG frame for each UNIT bytes."""
    word, size = diff_table()
    v = payload.reshape(-1, UNIT).astype(np.int64) - 128
    d = np.diff(v, axis=1, prepend=0) + 255
    n = size[d]
    total = n.sum(axis=1)
    n_bytes = (total + 7) >> 3
    pad = (n_bytes << 3) - total
    n = np.hstack([n, pad[:, None]])
    w = np.hstack([word[d], ((1 << pad) - 1).astype(np.uint64)[:, None]])
    words = (n_bytes + 3) >> 2  # of 32 bits; each frame starts a word
    base = np.cumsum(words) - words
    at = (np.cumsum(n, axis=1) - n + (base << 5)[:, None]).ravel()
    part = w.ravel() << (64 - (at & 31) - n.ravel()).astype(np.uint64)
    part[n.ravel() == 0] = 0
    slot = at >> 5
    starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
    acc = np.zeros(int(words.sum()) + 2, np.uint64)
    acc[slot[starts]] += np.add.reduceat(part, starts)
    low = acc & np.uint64(0xFFFFFFFF)
    acc >>= np.uint64(32)
    acc[1:] += low[:-1]
    raw = acc.astype(">u4").view(np.uint8)
    lengths, firsts = n_bytes, base << 2
    keep = np.repeat(firsts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    raw = raw[keep]
    twice = 1 + (raw == 255).astype(np.int64)
    ends = np.cumsum(twice)
    out = np.zeros(int(ends[-1]), np.uint8)
    out[ends - twice] = raw
    stops = ends[np.cumsum(lengths) - 1].tolist()
    scan, frames, a = out.tobytes(), [], 0
    for b in stops:
        frames.append(HEAD + scan[a:b] + END)
        a = b
    return frames


def riff(tag: bytes, body: bytes) -> bytes:
    return tag + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes], wide: int = WIDE * 8, high: int = HIGH * 8, fps: int = FPS) -> bytes:
    """RIFF AVI with one MJPG stream and an idx1 index."""
    most = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, 0x10, len(frames), 0, 1, most, wide, high, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, fps, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, wide, high)
    strf = struct.pack("<IiiHH4sIiiII", 40, wide, high, 1, 24, b"MJPG", wide * high * 3, 0, 0, 0, 0)
    hdrl = b"hdrl" + riff(b"avih", avih) + riff(b"LIST", b"strl" + riff(b"strh", strh) + riff(b"strf", strf))
    sizes = np.array([len(f) for f in frames], np.int64)
    offsets = np.cumsum(sizes + (sizes & 1) + 8) - (sizes + (sizes & 1) + 8) + 4
    index = np.zeros((len(frames), 4), "<u4")
    index[:, 0], index[:, 1], index[:, 2], index[:, 3] = int.from_bytes(b"00dc", "little"), 0x10, offsets, sizes
    movi = b"movi" + b"".join([x for f in frames for x in (b"00dc", struct.pack("<I", len(f)), f, b"\0" * (len(f) & 1))])
    body = b"AVI " + riff(b"LIST", hdrl) + riff(b"LIST", movi) + riff(b"idx1", index.tobytes())
    return b"RIFF" + struct.pack("<I", len(body)) + body


def chunks_of(raw: bytes, at: int, end: int):
    """(tag, start, size) of each chunk's body; a list's tag is that of its kind, and its body starts behind it."""
    while at + 8 <= end:
        tag, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        if tag in (b"LIST", b"RIFF"):
            yield raw[at + 8 : at + 12], at + 12, min(size, end - at - 8) - 4
        else:
            yield tag, at + 8, size
        at += 8 + size + (size & 1)


def read_avi(raw: bytes) -> tuple[list[bytes], float]:
    """Frames of the first video stream, and frames a second. By the index where there is one and the file has one part;
    else from all movi lists, those of further parts and their inner lists included."""
    if raw[:4] != b"RIFF" or raw[8:12] != b"AVI ":
        raise ValueError("not a RIFF AVI file")
    movis, index, micros, stream, streams = [], None, 1_000_000 // FPS, None, 0
    parts = list(chunks_of(raw, 0, len(raw)))
    for form, start, size in parts:
        if form not in (b"AVI ", b"AVIX"):
            continue
        for tag, at, n in chunks_of(raw, start, start + size):
            if tag == b"movi":
                movis.append((at, n))
            elif tag == b"idx1":
                index = np.frombuffer(raw, "<u4", n // 16 * 4, at).reshape(-1, 4)
            elif tag == b"hdrl":
                for inner, p, m in chunks_of(raw, at, at + n):
                    if inner == b"avih":
                        micros = struct.unpack_from("<I", raw, p)[0] or micros
                    elif inner == b"strl":
                        for own, q, _ in chunks_of(raw, p, p + m):
                            if own == b"strh" and raw[q : q + 4] == b"vids" and stream is None:
                                stream = streams
                        streams += 1
    if not movis:
        raise ValueError("no movi list")
    if stream is None:
        raise ValueError("no video stream")
    tags, frames = (b"%02ddc" % stream, b"%02ddb" % stream), []
    if index is not None and len(index) and len(parts) == 1:
        wanted, base = {int.from_bytes(x, "little") for x in tags}, movis[0][0] - 4
        base = base if int(index[0, 2]) < base else 0  # offsets from the list, or from the file's start
        return [raw[base + o + 8 : base + o + 8 + n] for tag, _, o, n in index.tolist() if tag in wanted], 1_000_000 / micros

    def walk(at: int, end: int):
        for tag, p, n in chunks_of(raw, at, end):
            if tag == b"rec ":
                walk(p, p + n)
            elif tag in tags:
                frames.append(raw[p : p + n])

    for at, n in movis:
        walk(at, at + n)
    return frames, 1_000_000 / micros


def parse_jpeg(frame: bytes) -> tuple[dict, int]:
    """Tables and shape, and where the scan's data starts."""
    if frame[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    at, quant, tables, got = 2, {}, dict(DEFAULTS), {}
    while True:
        marker, size = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        body = frame[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                n = 128 if body[0] >> 4 else 64
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if n == 128 else np.uint8).astype(np.int64)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                bits = tuple(body[1:17])
                n = sum(bits)
                tables[body[0] >> 4, body[0] & 15] = (bits, tuple(body[17 : 17 + n]))
                body = body[17 + n :]
        elif marker == 0xC0:
            _, high, wide, n = struct.unpack_from(">BHHB", body)
            got |= {"high": high, "wide": wide, "parts": {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}}
        elif marker == 0xDD:
            got["restart"] = struct.unpack(">H", body[:2])[0]
        elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xD0)) and marker != 0xCC:
            raise ValueError(f"JPEG segment {marker:02x} isn't baseline")
        elif marker == 0xDA:
            n = body[0]
            got["scan"] = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
            return got | {"quant": quant, "tables": tables}, at


class Decoder:
    """Decodes frames of equal headers together; keeps the tables of headers seen."""

    def __init__(self):
        self.heads: dict[bytes, dict] = {}
        self.last = b""

    def prepared(self, frame: bytes) -> tuple[bytes, dict]:
        if self.last and frame.startswith(self.last):
            return self.last, self.heads[self.last]
        p, at = parse_jpeg(frame)
        head = frame[:at]
        if head not in self.heads:
            if len(self.heads) > 64:
                self.heads.clear()
            h, v = max(x[0] for x in p["parts"].values()), max(x[1] for x in p["parts"].values())
            if len(p["scan"]) == 1:  # not interleaved: blocks in rows
                p["parts"] = {k: (1, 1, x[2]) for k, x in p["parts"].items()}
                h = v = 1
            p["mcus"] = (-(-p["high"] // (8 * v)), -(-p["wide"] // (8 * h)))
            p["order"] = [(i, y, x) for i, (c, _, _) in enumerate(p["scan"]) for y in range(p["parts"][c][1]) for x in range(p["parts"][c][0])]
            p["luts"] = [(lookup(*p["tables"][0, dc]), lookup(*p["tables"][1, ac])) for _, dc, ac in p["scan"]]
            p["flat"] = [flat_lookup(*x) for x in p["luts"]]
            self.heads[head] = p
        self.last = head
        return head, self.heads[head]

    def blocks(self, frames: list[bytes]) -> list[np.ndarray]:
        """Coefficients, dequantised, of each frame: (blocks in scan order, 64); (blocks, 1) where all have DC alone."""
        groups: dict[bytes, list[int]] = {}
        for i, f in enumerate(frames):
            groups.setdefault(self.prepared(f)[0], []).append(i)
        out: list = [None] * len(frames)
        for head, rows in groups.items():
            got = self.scans(self.heads[head], [frames[i][len(head) :] for i in rows])
            for k, i in enumerate(rows):
                out[i] = got[k]
        return out

    def scans(self, p: dict, scans: list[bytes]) -> list[np.ndarray]:
        """Coefficients of each scan. Restart markers cut a scan into runs, which are decoded like scans of their own."""
        if not p.get("restart"):
            return list(self.together(p, scans))
        mcus, run = p["mcus"][0] * p["mcus"][1], p["restart"]
        n, cut = -(-mcus // run), [RESTART.split(s) for s in scans]
        if any(len(c) != n for c in cut):
            raise ValueError("a restart marker is missing")
        whole = list(self.together(p | {"mcus": (1, run)}, [x for c in cut for x in c[: n - 1]])) if n > 1 else []
        last = list(self.together(p | {"mcus": (1, mcus - (n - 1) * run)}, [c[-1] for c in cut]))
        out = []
        for i in range(len(scans)):
            parts = [*whole[i * (n - 1) : (i + 1) * (n - 1)], last[i]]
            wide = max(x.shape[1] for x in parts)
            out.append(np.concatenate([np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in parts]))
        return out

    def flat(self, p: dict, raw: np.ndarray, sizes: np.ndarray, total: int) -> np.ndarray | None:
        """DC values of frames whose blocks are all flat, else None: one look ahead a block."""
        per, w = len(p["order"]), raw.astype(np.uint32)
        ahead = (w[:-3] << 24) | (w[1:-2] << 16) | (w[2:-1] << 8) | w[3:]
        pos, last = (np.cumsum(sizes) - sizes).astype(np.int64) * 8, np.cumsum(sizes) * 8
        hits = np.empty((total, len(sizes)), np.int32)
        for block in range(total):
            hit = p["flat"][p["order"][block % per][0]][(ahead[pos >> 3] << (pos & 7).astype(np.uint32)) >> 14]
            if not hit.all():
                return None
            hits[block] = hit
            pos += hit & 255
        if (pos > last).any():
            raise ValueError("a frame ends early")
        diffs, out = ((hits >> 8) - 2048).T, np.empty((len(sizes), total), np.int64)
        parts = np.array([p["order"][b % per][0] for b in range(total)])
        for part in range(len(p["scan"])):
            out[:, parts == part] = np.cumsum(diffs[:, parts == part], axis=1)
        return out

    def together(self, p: dict, scans: list[bytes]) -> np.ndarray:
        n, per = len(scans), len(p["order"])
        total = p["mcus"][0] * p["mcus"][1] * per
        sizes = np.array([len(s) for s in scans])
        raw = np.frombuffer(b"".join(scans), np.uint8)
        stuffed = np.append(False, (raw[1:] == 0) & (raw[:-1] == 255))
        frame_of = np.repeat(np.arange(n), sizes)
        dropped = np.bincount(frame_of[stuffed], minlength=n)
        raw = raw[~stuffed]
        sizes = sizes - dropped
        raw = np.concatenate([raw, np.full(16, 255, np.uint8)])
        q = np.array([p["quant"][p["parts"][p["scan"][p["order"][b % per][0]][0]][2]][0] for b in range(total)])
        if (dc := self.flat(p, raw, sizes, total)) is not None:
            return (dc * q)[:, :, None]
        raw = raw.astype(np.uint64)
        u = np.uint64
        ahead = (raw[:-8] << u(56)) | (raw[1:-7] << u(48)) | (raw[2:-6] << u(40)) | (raw[3:-5] << u(32)) | (raw[4:-4] << u(24)) | (raw[5:-3] << u(16)) | (raw[6:-2] << u(8)) | raw[7:-1]
        pos = (np.cumsum(sizes) - sizes) * 8
        last = np.cumsum(sizes) * 8
        dc = np.zeros((n, total), np.int64)
        ac: dict[int, np.ndarray] = {}
        pred = np.zeros((n, len(p["scan"])), np.int64)
        quant = [p["quant"][p["parts"][c][2]] for c, _, _ in p["scan"]]
        rows = np.arange(n)

        def signed(bits, s):
            return np.where(bits < (1 << np.maximum(s - 1, 0)), bits - (1 << s) + 1, bits) * (s > 0)

        coef = None
        for block in range(total):
            part = p["order"][block % per][0]
            dc_lut, ac_lut = p["luts"][part]
            w = ahead[pos >> 3] << (pos & 7).astype(u)
            hit = dc_lut[(w >> u(48)).astype(np.int64)]
            length, s = hit >> 8, hit & 255
            if not length.all():
                raise ValueError("bad DC code")
            w = w << length.astype(u)
            bits = ((w >> u(32)) >> (32 - s).astype(u)).astype(np.int64)
            w = w << s.astype(u)
            pred[:, part] += signed(bits, s.astype(np.int64))
            dc[:, block] = pred[:, part]
            pos = pos + length + s
            live, k = rows, np.ones(n, np.int64)
            first = True
            while len(live):
                if not first:
                    w = ahead[pos[live] >> 3] << (pos[live] & 7).astype(u)
                hit = ac_lut[(w >> u(48)).astype(np.int64)]
                length, symbol = hit >> 8, hit & 255
                if first and (hit == hit[0]).all() and symbol[0] == 0 and length[0]:
                    pos = pos + length[0]  # all blocks end here
                    break
                if not length.all():
                    raise ValueError("bad AC code")
                w = w << length.astype(u)
                run, s = symbol >> 4, (symbol & 15).astype(np.int64)
                bits = ((w >> u(32)) >> (32 - s).astype(u)).astype(np.int64)
                pos[live] += length + s
                k[live] += run
                some = s > 0
                if some.any():
                    if coef is None:
                        coef = np.zeros((n, total, 64), np.int32)
                    if (k[live[some]] > 63).any():
                        raise ValueError("too many coefficients")
                    coef[live[some], block, ZIGZAG[k[live[some]]]] = signed(bits, s)[some]
                k[live] += 1
                live = live[(symbol != 0) & (k[live] < 64)]
                first = False
        if (pos > last).any():
            raise ValueError("a frame ends early")
        if coef is None:
            return (dc * q)[:, :, None]
        full = np.stack([quant[p["order"][b % per][0]] for b in range(total)])
        table = np.zeros_like(full)
        table[:, ZIGZAG] = full
        coef[:, :, 0] = dc
        return coef * table

    def greys(self, frames: list[bytes]) -> list[np.ndarray]:
        """Mean grey (0 to 255) of each block of each frame's first component, in rows."""
        heads = [self.prepared(f)[0] for f in frames]
        coefs = self.blocks(frames)
        if heads and heads.count(heads[0]) == len(heads) and len({c.shape for c in coefs}) == 1:
            return list(self.planes(self.heads[heads[0]], np.stack([c[:, 0] for c in coefs])))
        return [self.planes(self.heads[h], c[None, :, 0])[0] for h, c in zip(heads, coefs, strict=True)]

    def planes(self, p: dict, dc: np.ndarray) -> np.ndarray:
        """(frames, blocks in scan order) of DC values to (frames, rows, columns) of greys."""
        first = [i for i, x in enumerate(p["order"]) if x[0] == 0]
        h, v = max(p["order"][i][2] for i in first) + 1, max(p["order"][i][1] for i in first) + 1
        (rows, cols), per = p["mcus"], len(p["order"])
        dc = dc.reshape(-1, rows, cols, per)[..., first].reshape(-1, rows, cols, v, h).transpose(0, 1, 3, 2, 4).reshape(-1, rows * v, cols * h)
        return np.clip((dc + 4) // 8 + 128, 0, 255).astype(np.uint8)

    def pixels(self, frame: bytes) -> np.ndarray:
        """Samples (component, height, width) of one frame, chroma repeated to full size."""
        _, p = self.prepared(frame)
        (coef,) = self.blocks([frame])
        if coef.shape[1] == 1:
            coef = np.pad(coef, ((0, 0), (0, 63)))
        flat = np.einsum("ux,nuv,vy->nxy", DCT, coef.reshape(-1, 8, 8).astype(float), DCT)
        flat = np.clip(np.rint(flat + 128), 0, 255).astype(np.uint8)
        (rows, cols), per, out = p["mcus"], len(p["order"]), []
        flat = flat.reshape(rows, cols, per, 8, 8)
        for c in range(len(p["scan"])):
            own = [i for i, x in enumerate(p["order"]) if x[0] == c]
            h, v = max(p["order"][i][2] for i in own) + 1, max(p["order"][i][1] for i in own) + 1
            plane = flat[:, :, own].reshape(rows, cols, v, h, 8, 8).transpose(0, 2, 4, 1, 3, 5).reshape(rows * v * 8, cols * h * 8)
            out.append(plane)
        high, wide = max(x.shape[0] for x in out), max(x.shape[1] for x in out)
        return np.stack([x.repeat(high // x.shape[0], 0).repeat(wide // x.shape[1], 1)[: p["high"], : p["wide"]] for x in out])


def histograms(greys: np.ndarray, bins: int = 16) -> np.ndarray:
    """(frames, blocks) to shares (frames, bins)."""
    n, m = greys.shape
    at = (greys.astype(np.int64) * bins >> 8) + np.arange(n)[:, None] * bins
    return np.bincount(at.ravel(), minlength=n * bins).reshape(n, bins) / m


def shots(hist: np.ndarray, k: float = 2.5, reach: int = 12, floor: float = 0.12) -> list[tuple[int, int]]:
    """Frame ranges [a, b) between the cuts."""
    if len(hist) < 2:
        return [(0, len(hist))] if len(hist) else []
    d = np.abs(np.diff(hist, axis=0)).sum(axis=1) / 2
    one, two, n = np.cumsum(np.append(0, d)), np.cumsum(np.append(0, d * d)), len(d)
    lo, hi = np.maximum(np.arange(n) - reach, 0), np.minimum(np.arange(n) + reach + 1, n)
    m = hi - lo - 1  # without the difference itself
    mean = np.where(m > 0, (one[hi] - one[lo] - d) / np.maximum(m, 1), 0)
    var = np.where(m > 0, (two[hi] - two[lo] - d * d) / np.maximum(m, 1) - mean**2, 0)
    cuts = np.flatnonzero((d > floor) & (d > mean + k * np.sqrt(np.maximum(var, 0)) + 1e-12)) + 1
    edges = [0, *cuts.tolist(), len(hist)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def timed(hist: np.ndarray, fps: float) -> list[tuple[int, float, float, int]]:
    """(number, start and end in seconds, frames) of each shot."""
    return [(i, a / fps, z / fps, z - a) for i, (a, z) in enumerate(shots(hist))]


def store(payload: bytes) -> bytes:
    """AVI file of a payload whose length is a multiple of UNIT."""
    flat, frames = np.frombuffer(payload, np.uint8), []
    for at in range(0, len(flat), CODED * UNIT):
        frames += encode_frames(flat[at : at + CODED * UNIT])
    return write_avi(frames)


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    return raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" "), len(raw)


def load(media: list[bytes], decoder: Decoder) -> list[np.ndarray]:
    """(frames, blocks) of greys of each file, decoded together."""
    files = [read_avi(m)[0] for m in media]
    flat = [f for fs in files for f in fs]
    greys = []
    for at in range(0, len(flat), AT_ONCE):
        greys += decoder.greys(flat[at : at + AT_ONCE])
    out, at = [], 0
    for fs in files:
        out.append(np.stack([g.ravel() for g in greys[at : at + len(fs)]]))
        at += len(fs)
    return out


def describe(greys: np.ndarray) -> str:
    """Frames, shots and mean histogram."""
    hist = histograms(greys)
    cuts = shots(hist)
    return f"frames={len(greys)};shots={len(cuts)};cuts={','.join(str(a) for a, _ in cuts[1:])};hist={','.join(str(int(x)) for x in np.rint(hist.mean(axis=0) * 1000))}"


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media) with the AVI file of each text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batches):
        for b in batches:
            for row, text in zip(b.column(0), b.column(1), strict=True):
                raw, n = padded(text.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([row], b.schema.field(0).type), pa.array([n], pa.int64()), pa.array([store(raw)], pa.binary())], ["id", "n_bytes", "media"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, f"id {kind}, n_bytes long, media binary")


def clips(files: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id, clip, start_s, end_s, frames) of each shot of each AVI file; a null file has none."""
    kind = files.schema[id_col].dataType.simpleString()

    def each(batches):
        decoder = Decoder()
        for b in batches:
            rows = []
            for row, media in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                if media is None:
                    continue
                frames, fps = read_avi(media)
                hist = np.concatenate([histograms(g.reshape(1, -1)) for at in range(0, len(frames), AT_ONCE) for g in decoder.greys(frames[at : at + AT_ONCE])]) if frames else np.zeros((0, 16))
                rows += [(row, *x) for x in timed(hist, fps)]
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(list(c[0]), b.schema.field(0).type), pa.array(c[1], pa.int32()), pa.array(c[2], pa.float64()), pa.array(c[3], pa.float64()), pa.array(c[4], pa.int32())], ["id", "clip", "start_s", "end_s", "frames"])

    return files.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(each, f"id {kind}, clip int, start_s double, end_s double, frames int")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_once: int = 4 << 20) -> DataFrame:
    """Stores each text as an AVI file, reads the file's bytes back and describes them; texts go together
    until they hold at_once bytes."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "clips"]
    clip = pa.list_(pa.struct([("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32())]))

    def each(batches):
        decoder = Decoder()

        def out(ids, sizes, payloads, field):
            joined = np.frombuffer(b"".join(payloads), np.uint8)
            frames = []
            for at in range(0, len(joined), CODED * UNIT):
                frames += encode_frames(joined[at : at + CODED * UNIT])
            media, at = [], 0
            for p in payloads:
                media.append(write_avi(frames[at : at + len(p) // UNIT]))
                at += len(p) // UNIT
            rows = []
            for m, n, greys in zip(media, sizes, load(media, decoder), strict=True):
                back = greys.tobytes()
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(m), hashlib.sha256(m).hexdigest(), describe(greys), [dict(zip(("clip", "start_s", "end_s", "frames"), x, strict=True)) for x in timed(histograms(greys), FPS)]))
            c = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), clip]
            return pa.RecordBatch.from_arrays([pa.array(ids, field.type), *(pa.array(x, t) for x, t in zip(c, kinds, strict=True))], names)

        for b in batches:
            ids, sizes, payloads, held = [], [], [], 0
            for row, text in zip(b.column(0), b.column(1), strict=True):
                raw, n = padded(text.as_py())
                ids.append(row)
                sizes.append(n)
                payloads.append(raw)
                held += len(raw)
                if held >= at_once:
                    yield out(ids, sizes, payloads, b.schema.field(0))
                    ids, sizes, payloads, held = [], [], [], 0
            if ids:
                yield out(ids, sizes, payloads, b.schema.field(0))

    schema = f"{id_col} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips array<struct<clip:int,start_s:double,end_s:double,frames:int>>"
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(each, schema)
