"""Media: files of other makes, restart markers, and stored columns against plain computations."""

import hashlib
import struct
import zlib

import numpy as np
import pytest

from evidentia.llm import media


def scan_of(values):
    """Bits of flat blocks' greys, as a byte string, padded with ones and stuffed."""
    word, size = media.diff_table()
    bits = "".join(format(int(word[d + 255]), f"0{int(size[d + 255])}b") for d in np.diff(np.asarray(values, int) - 128, prepend=0))
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


@pytest.mark.parametrize("run", [16, 50, 191, 192])
def test_restart_markers(run):
    r = np.random.default_rng(run)
    dri = media.segment(0xDD, struct.pack(">H", run))
    head = media.HEAD[:2] + dri + media.HEAD[2:]
    payloads = [r.integers(0, 256, media.UNIT).astype(np.uint8) for _ in range(3)]
    frames = []
    for p in payloads:
        parts = [scan_of(p[i : i + run]) for i in range(0, media.UNIT, run)]
        frames.append(head + b"".join(x + (b"\xff" + bytes([0xD0 + i % 8]) if i < len(parts) - 1 else b"") for i, x in enumerate(parts)) + media.END)
    got = media.Decoder().greys(frames)
    assert all((g.ravel() == p).all() for g, p in zip(got, payloads, strict=True))
    if run < 191:
        broken = frames[0].replace(b"\xff\xd0", b"", 1)
        with pytest.raises(ValueError):
            media.Decoder().greys([broken])


def strl(kind):
    return media.riff(b"LIST", b"strl" + media.riff(b"strh", kind + b"MJPG" + bytes(48)))


def test_other_files():
    frames = media.encode_frames(np.arange(3 * media.UNIT, dtype=np.int64).astype(np.uint8))
    avih = media.riff(b"avih", struct.pack("<14I", 50_000, *[0] * 13))
    hdrl = media.riff(b"LIST", b"hdrl" + avih + strl(b"auds") + strl(b"vids"))
    one = media.riff(b"LIST", b"rec " + media.riff(b"00wb", b"sound") + media.riff(b"01dc", frames[0]))
    movi = media.riff(b"LIST", b"movi" + one + media.riff(b"01db", frames[1]))
    more = media.riff(b"RIFF", b"AVIX" + media.riff(b"LIST", b"movi" + media.riff(b"01dc", frames[2])))
    raw = media.riff(b"RIFF", b"AVI " + hdrl + movi) + more
    assert media.read_avi(raw) == (frames, 20.0)
    for bad in (b"RIFF", media.riff(b"RIFF", b"WAVE"), media.riff(b"RIFF", b"AVI " + hdrl), media.riff(b"RIFF", b"AVI " + media.riff(b"LIST", b"hdrl" + avih + strl(b"auds")) + movi)):
        with pytest.raises(ValueError):
            media.read_avi(bad)
    plain = media.write_avi(frames)
    assert media.read_avi(plain)[0] == frames and media.read_avi(plain.replace(b"idx1", b"junk"))[0] == frames


def test_columns_are_plain_computations(spark):
    texts = [None, "", "short", "a" * 192, "é" * 500, "dark \x01" * 400 + "ÿþ~" * 900, "x" * 200_000, "short"]
    d = spark.createDataFrame([(i if i else None, t, "m") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    for r in media.round_trip(d).collect():
        raw = (texts[r.doc_id or 0] or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")
        file = media.write_avi([media.HEAD + scan_of(list(payload[i : i + 192])) + media.END for i in range(0, len(payload), 192)])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
        n = len(payload) // 192
        hist = np.array([np.bincount(np.frombuffer(payload[i * 192 : i * 192 + 192], np.uint8) >> 4, minlength=16) / 192 for i in range(n)])
        diff = [np.abs(hist[i + 1] - hist[i]).sum() / 2 for i in range(n - 1)]
        cuts = []
        for i, x in enumerate(diff):
            around = [y for j, y in enumerate(diff) if abs(i - j) <= 12 and j != i]
            mean, dev = (np.mean(around), np.std(around)) if around else (0, 0)
            if x > 0.12 and x > mean + 2.5 * dev + 1e-9:
                cuts.append(i + 1)
        assert f";shots={len(cuts) + 1};cuts={','.join(map(str, cuts))};" in r.feature and r.feature.startswith(f"frames={n};")
        edges = [0, *cuts, n]
        assert [(c.clip, c.frames, round(c.start_s * 25), round(c.end_s * 25)) for c in r.clips] == [(i, b - a, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
