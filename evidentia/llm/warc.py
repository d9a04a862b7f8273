"""WARC archives packed in ZIP files: writer, and a reader that needs no extraction.

Each record is a gzip member of its own, as WARC files are usually kept; the writer stores (never deflates)
one WARC member and one index member in each ZIP file, so a record is a byte range of the file. The reader takes any `read(offset, length)` function: it finds
the end-of-central-directory record, follows the ZIP64 locator where there is one, parses the
central directory with ZIP64 extra fields, locates the members' data behind their local headers,
and range-reads the index and then each record.

Of records with equal payloads of `least` bytes or more, that with the largest id is a response and
the others are revisits that refer to it. Digests that come more than once are found without payloads; a bitmap
of them, of a fixed largest size, tells which payloads may be such, and only these are shuffled, a digest's rows to
several tasks. All others are written where they are read. Archives are files in the shared folder, under names that
no two task attempts share; only files listed by finished tasks are read, so a lost executor or a
repeated task leaves nothing wrong behind. A task streams records and holds one at a time.

Defined cases: a null html is an empty payload, and empty payloads are all responses. A null url is
written without WARC-Target-URI. A null id is no candidate for the largest; a payload seen under null
ids only is a response each time. Rows that repeat the largest id are all responses. An empty table
writes no archive. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import urllib.parse
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, open_path, shared_dir

CRLF, PAGE = b"\r\n", "urn:page:"
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
# fixed values of the ZIP format
EOCD, EOCD64, LOCATOR, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def record(kind: str, page: str, payload: bytes | None, length: int, sha1: str, url: str | None, refers: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head alone."""
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + (payload or b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{PAGE}{page}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers is not None:
        head += [("WARC-Refers-To", f"<{PAGE}{refers}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + CRLF + CRLF


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (names in lower case) and payload."""

    def fields(part: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in part.decode("utf-8").split("\r\n")[1:]) if k}

    head, _, rest = raw.partition(CRLF + CRLF)
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(CRLF + CRLF)
    return warc, fields(http), payload


class ZipRanges:
    """Directory of a ZIP file reached by read(offset, length) alone; stored members are read by range."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, tail = read, min(size, 65557)
        end = read(size - tail, tail)
        at = end.rfind(EOCD)
        while at >= 0 and at + 22 + int.from_bytes(end[at + 20 : at + 22], "little") != len(end):
            at = end.rfind(EOCD, 0, at)  # the signature stands in the comment
        if at < 0:
            raise ValueError("no end of central directory")
        n, length, start = struct.unpack_from("<HII", end, at + 10)
        if at >= 20 and end[at - 20 : at - 16] == LOCATOR:
            (where,) = struct.unpack_from("<Q", end, at - 12)
            if (raw := read(where, 56))[:4] != EOCD64:
                raise ValueError("no ZIP64 end of central directory")
            n, length, start = struct.unpack_from("<QQQ", raw, 32)
        self.members: dict[str, tuple[int, int]] = {}  # name: offset of the data, size
        raw, p = read(start, length), 0
        for _ in range(n):
            if raw[p : p + 4] != CENTRAL:
                raise ValueError("bad central directory")
            method = struct.unpack_from("<H", raw, p + 10)[0]
            packed, plain, names, extras, comment = struct.unpack_from("<IIHHH", raw, p + 20)
            (local,) = struct.unpack_from("<I", raw, p + 42)
            name, q = raw[p + 46 : p + 46 + names].decode("utf-8"), p + 46 + names
            while q + 4 <= p + 46 + names + extras:
                tag, m = struct.unpack_from("<HH", raw, q)
                if tag == 1:  # ZIP64: the fields that don't fit, in this order
                    more = iter(struct.unpack_from(f"<{m // 8}Q", raw, q + 4))
                    plain, packed, local = (next(more) if x == 0xFFFFFFFF else x for x in (plain, packed, local))
                q += 4 + m
            p += 46 + names + extras + comment
            if method == 0:
                head = read(local, 30)
                if head[:4] != LOCAL:
                    raise ValueError("bad local header")
                a, b = struct.unpack_from("<HH", head, 26)
                self.members[name] = (local + 30 + a + b, plain)

    def range(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        start, size = self.members[name]
        length = size - offset if length is None else length
        if offset < 0 or length < 0 or offset + length > size:
            raise ValueError("range outside the member")
        return self.read(start + offset, length)

    def records(self) -> Iterator[bytes]:
        """Each record of the archive, by the index's ranges."""
        for line in self.range(INDEX).decode().splitlines():
            _, offset, length = line.rsplit(" ", 2)
            raw = self.range(MEMBER, int(offset), int(length))
            yield gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw


def open_zip(uri: str) -> tuple[ZipRanges, object]:
    f = open_path(uri, "rb")
    size = f.seek(0, 2)
    size = f.tell() if size is None else size

    def read(offset: int, length: int) -> bytes:
        f.seek(offset)
        return f.read(length)

    return ZipRanges(read, size), f


SALTS, MOST_BITS = 16, 26


def repeated(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(s, rep): digests of `least` bytes or more that come more than once, and the id that is referred to."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.sha1(html).alias("s"), F.octet_length(html).alias("length")).where(F.col("length") >= least)
    return rows.groupBy("s").agg(F.max("page_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("s", "rep")


def bitmap(same: DataFrame) -> np.ndarray:
    """Bits of the digests' first 32 bits: a power of two, 16 for each digest, 2 ** MOST_BITS at most."""
    bits = min(MOST_BITS, max(16, (16 * same.count()).bit_length()))
    slot, words = F.conv(F.substring("s", 1, 8), 16, 10).cast("long").bitwiseAND((1 << bits) - 1), np.zeros(1 << bits - 6, np.uint64)
    rows = same.select(slot.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits"))
    for r in rows.collect():  # 2 ** (MOST_BITS - 6) at most
        words[r.w] = np.uint64(r.bits & ((1 << 64) - 1))
    return words


def name_of(page) -> str:
    return "null" if page is None else "id-" + urllib.parse.quote(str(page), safe="")


class Packer:
    """Puts records into archives of about `roll` bytes under a folder."""

    def __init__(self, folder: str, roll: int):
        self.folder, self.roll, self.file = folder, roll, None

    def add(self, page, url: str | None, payload: bytes, sha1: str, rep) -> pa.RecordBatch | None:
        """The archive that is full, if one is."""
        old = rep is not None and page != rep
        raw = gzip.compress(record("revisit" if old else "response", name_of(page), None if old else payload, len(payload), sha1, url, name_of(rep) if old else None), 3, mtime=0)
        if self.file is None:
            self.uri, self.offset, self.index = f"{self.folder}/{uuid.uuid4().hex}.zip", 0, []
            self.file = open_path(self.uri, "wb")
            self.zipped = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
            self.member = self.zipped.open(zipfile.ZipInfo(MEMBER), "w", force_zip64=True)
        self.member.write(raw)
        self.index.append((name_of(page), self.offset, len(raw)))
        self.offset += len(raw)
        return self.close() if self.offset >= self.roll else None

    def close(self) -> pa.RecordBatch | None:
        if self.file is None:
            return None
        self.member.close()
        with self.zipped.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            f.writelines(f"{page} {at} {size}\n".encode() for page, at, size in self.index)
        self.zipped.close()
        self.file.close()
        self.file = None
        return pa.RecordBatch.from_arrays([pa.array([self.uri]), pa.array([len(self.index)], pa.int64())], ["uri", "n"])


def write_archives(pages: DataFrame, folder: str, least: int = 1000, roll: int = 4 << 20) -> DataFrame:
    """Writes ZIP-packed WARC archives of about `roll` bytes under folder; returns (uri, n) of each."""
    same = cut(repeated(pages, least), "warc-same")
    known = pages.sparkSession.sparkContext.broadcast(bitmap(same))
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batch):
        """(page, url, payload, sha1, whether it may come more than once)"""
        words = known.value
        for page, url, html in zip(*batch.columns, strict=True):
            payload = (html.as_py() or "").encode()
            sha1 = hashlib.sha1(payload).hexdigest()
            slot = int(sha1[:8], 16) & (len(words) * 64 - 1)
            yield page.as_py(), url.as_py(), payload, sha1, len(payload) >= least and bool(words[slot >> 6] >> np.uint64(slot & 63) & np.uint64(1))

    def alone(batches):
        out = Packer(folder, roll)
        for b in batches:
            for page, url, payload, sha1, many in read(b):
                if not many and (full := out.add(page, url, payload, sha1, None)):
                    yield full
        if (last := out.close()) is not None:
            yield last

    def shared(batches):
        for b in batches:
            rows, held = [], 0

            def some():
                c = list(zip(*rows, strict=True))
                return pa.RecordBatch.from_arrays([pa.array(c[0], b.schema.field(0).type), *(pa.array(x, t) for x, t in zip(c[1:], (pa.string(), pa.binary(), pa.string()), strict=True))], ["page_id", "url", "payload", "s"])

            for *row, many in read(b):
                if many:
                    rows.append(row)
                    held += len(row[2])
                    if held > 4 << 20:
                        yield some()
                        rows, held = [], 0
            if rows:
                yield some()

    def referring(batches):
        out = Packer(folder, roll)
        for b in batches:
            for row in zip(*b.columns, strict=True):
                if full := out.add(*(x.as_py() for x in row)):
                    yield full
        if (last := out.close()) is not None:
            yield last

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    often = rows.mapInArrow(shared, f"page_id {kind}, url string, payload binary, s string").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("long"))
    salted = same.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    often = often.join(salted, ["s", "salt"], "left").select("page_id", "url", "payload", "s", "rep")
    return rows.mapInArrow(alone, "uri string, n long").union(often.mapInArrow(referring, "uri string, n long"))


def read_archives(archives: DataFrame, id_type: str = "long") -> DataFrame:
    """One row for each record of the archives (column uri): page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for revisits)."""
    schema = f"page_id {id_type}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}, payload binary"
    to = int if id_type in ("long", "bigint", "int") else str

    def each(batches):
        kinds = [pa.int64() if to is int else pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64() if to is int else pa.string(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        def ident(x):
            x = x.removeprefix(f"<{PAGE}").removesuffix(">")
            return None if x == "null" else to(urllib.parse.unquote(x.removeprefix("id-")))

        for b in batches:
            for uri in b.column(0).to_pylist():
                zipped, f = open_zip(uri)
                rows, held = [], 0
                with f:
                    for raw in zipped.records():
                        warc, http, payload = parse_record(raw)
                        page, old = ident(warc["warc-record-id"]), warc["warc-type"] == "revisit"
                        digest = warc["warc-payload-digest"].removeprefix("sha1:")
                        if not old and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {page} doesn't match its digest")
                        rows.append((page, warc.get("warc-target-uri"), int(http["content-length"]) if old else len(payload), digest, warc["warc-type"], ident(warc["warc-refers-to"]) if old else None, None if old else payload))
                        held += len(raw)
                        if held > 4 << 20:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    return archives.select("uri").mapInArrow(each, schema)


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads them back."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    archives = cut(write_archives(pages, folder, least), "warc")
    n = max(1, archives.count())
    return read_archives(archives.repartition(min(n, 10_000)), pages.schema["page_id"].dataType.simpleString().replace("bigint", "long"))


ORACLE_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
q as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest from p),
m as (select *, max(page_id) over (partition by payload_digest) as rep from q)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and rep is not null and page_id is distinct from rep then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and rep is not null and page_id is distinct from rep then rep end as refers_to from m
"""
