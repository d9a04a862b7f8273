"""The observation archive: one gzip JSON object for each envelope, created once and never changed.

An object's metadata stands in the comment of its gzip header, so that it is stored with the object in one step and
every reader of gzip still reads the object."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import EPOCH_MS, INSTANT, UUID7, uuid7
from ..schemas import ENVELOPE, HTTP_KINDS, KINDS
from .store import Store, store_at

PREFIX = "observations/v1"
BACKFILL = f"{PREFIX}/source=http_backfill"


def instant(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(UTC)


def wire_time(t: datetime) -> str:
    return t.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"


def key_of(env: dict) -> str:
    t = instant(env["observed_at"])
    return f"{PREFIX}/source={env['source_kind']}/year={t:%Y}/month={t:%m}/day={t:%d}/hour={t:%H}/{env['observation_id'].lower()}.json.gz"


def key_column(kind: Column, observed_at: Column, observation_id: Column) -> Column:
    """The same of columns; observed_at is a timestamp."""
    t = F.to_utc_timestamp(observed_at, F.current_timezone())
    return F.concat(F.lit(f"{PREFIX}/source="), kind, F.date_format(t, "'/year='yyyy'/month='MM'/day='dd'/hour='HH/"), F.lower(observation_id), F.lit(".json.gz"))


def payload_text(env: dict) -> str:
    """The payload as it was received where the envelope keeps that (raw), else as it is written."""
    return env["raw"] if "raw" in env else json.dumps(env["payload"], ensure_ascii=False, separators=(",", ":"))


def refused(env) -> str | None:
    """Why an envelope can't be archived; null if it can."""
    if not isinstance(env, dict) or env.get("envelope_version") != "v1":
        return "envelope_version"
    if not re.match(UUID7, str(env.get("observation_id"))):
        return "observation_id"
    if env.get("source_kind") not in KINDS:
        return "source_kind"
    if env["source_kind"] in HTTP_KINDS and not isinstance(env.get("provenance"), dict):
        return "provenance"
    if not re.match(INSTANT, str(env.get("observed_at"))):
        return "observed_at"
    return "payload" if env.get("payload") is None else None


def metadata(env: dict) -> dict[str, str]:
    return {"format": "json", "compression": "gzip", "envelope_version": env["envelope_version"], "observation_id": env["observation_id"].lower(), "source_kind": env["source_kind"], "payload_sha256": hashlib.sha256(payload_text(env).encode()).hexdigest()}


def encode(env: dict) -> bytes:
    """Gzip of the envelope's JSON, the payload's text unchanged in it; the header's comment holds the metadata."""
    rest = json.dumps({k: v for k, v in env.items() if k not in ("payload", "raw")}, ensure_ascii=False, separators=(",", ":"))
    body = f'{rest[:-1]},"payload":{payload_text(env)}}}'.encode()
    pack = zlib.compressobj(9, zlib.DEFLATED, -zlib.MAX_WBITS)
    head = b"\x1f\x8b\x08\x10" + bytes(6) + json.dumps(metadata(env)).encode("latin-1") + b"\0"
    return head + pack.compress(body) + pack.flush() + struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)


def decode(raw: bytes) -> dict:
    """The envelope of an object; an object that is none is an error."""
    try:
        env = json.loads(gzip.decompress(raw))
    except (OSError, EOFError, zlib.error, ValueError) as e:
        raise ValueError(f"damaged object: {e}") from e
    if why := refused(env):
        raise ValueError(f"refused envelope: {why}")
    return env


def stored_metadata(raw: bytes) -> dict[str, str]:
    """What the header's comment says; computed where there is none."""
    if raw[:4] == b"\x1f\x8b\x08\x10":
        return json.loads(raw[10 : raw.index(b"\0", 10)].decode("latin-1"))
    return metadata(decode(raw))


def put(root: str | Store, env: dict) -> str:
    """'created', or 'idempotent_retry' for the same payload; another payload under the id is an error."""
    if why := refused(env):
        raise ValueError(f"refused envelope: {why}")
    store, key = store_at(root) if isinstance(root, str) else root, key_of(env)
    if store.put_if_absent(key, encode(env)):
        return "created"
    had, new = stored_metadata(store.get(key)), metadata(env)
    if any(had.get(k) != new[k] for k in ("observation_id", "payload_sha256")):
        raise ValueError(f"{key} holds another observation")
    return "idempotent_retry"


def get(root: str | Store, key: str) -> dict:
    raw = (store_at(root) if isinstance(root, str) else root).get(key)
    if raw is None:
        raise LookupError(key)
    return decode(raw)


def delete(root: str | Store, key: str) -> bool:
    """For cleaning up; True if the object was there."""
    return (store_at(root) if isinstance(root, str) else root).delete(key)


def _envelopes(raw: DataFrame) -> DataFrame:
    raw = raw.select("value", F.col("_metadata.file_path").alias("key"), F.col("_metadata.file_modification_time").alias("uploaded_at"))
    return raw.select("key", "uploaded_at", F.from_json("value", ENVELOPE, {"mode": "FAILFAST"}).alias("e")).select("key", "uploaded_at", "e.*")


def read(spark: SparkSession, root: str, prefix: str = BACKFILL) -> DataFrame:
    """Envelopes with key and upload time. A damaged object fails the job; the id comes from the content."""
    return _envelopes(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").text(f"{root.rstrip('/')}/{prefix}", wholetext=True))


def read_keys(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    """Like read, of these objects alone: the archive isn't listed."""
    return _envelopes(spark.read.text(list(keys), wholetext=True))


def listing(spark: SparkSession, root: str, prefix: str = BACKFILL) -> DataFrame:
    """(key, uploaded_at) without reading the objects."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").load(f"{root.rstrip('/')}/{prefix}")
    return files.select(F.col("path").alias("key"), F.col("modificationTime").alias("uploaded_at"))


def append(envelopes: DataFrame, existing: DataFrame) -> DataFrame:
    """Envelopes that an archive table doesn't hold yet; an id with another payload is an error."""
    h = F.sha2(F.col("payload").cast("binary"), 256)
    old = existing.select("observation_id", h.alias("old"))
    got = envelopes.join(old, "observation_id", "left").withColumn("payload", F.when(F.col("old").isNotNull() & (F.col("old") != h), F.raise_error(F.lit("one observation id, two payloads"))).otherwise(F.col("payload")))
    return got.where("old is null").drop("old")


def fixture(pages: int = 4, size: int = 25, overlap: int = 5, base: str = "2026-09-21T00:00:00Z") -> list[dict]:
    """Overlapping pages of messages; the same ones each time."""
    if pages <= 0 or size <= 0 or overlap >= size:
        raise ValueError("pages and size must be positive, overlap below size")
    start, out = instant(base), []

    def snowflake(t: datetime, i: int) -> str:
        return str((int(t.timestamp() * 1000) - EPOCH_MS) << 22 | i & 0xFFF)

    guild, channel = "100000000000000001", "200000000000000002"
    for p in range(pages):
        seen, first = start + timedelta(minutes=p), p * (size - overlap)
        messages = []
        for i in range(first, first + size):
            made = start - timedelta(seconds=1000 - i)
            messages.append({
                "id": snowflake(made, i), "channel_id": channel, "author": {"id": f"3000000000000000{i % 10:02d}", "username": f"user{i % 10:02d}", "bot": False}, "content": f"message {i} seen on page {p}",
                "timestamp": wire_time(made), "edited_timestamp": wire_time(seen - timedelta(seconds=30)) if i % 7 == 0 else None, "pinned": i % 11 == 0, "type": 0, "attachments": [], "embeds": [], "mention_everyone": False,
            })
        # fixed values: ids, names and limits of the shared fixture
        out.append({
            "envelope_version": "v1", "observation_id": uuid7(int(seen.timestamp() * 1000), f"page {p}".encode()), "source_kind": "http_backfill", "observed_at": wire_time(seen), "payload": messages,
            "provenance": {
                "run_id": "0199a1b2-0000-7000-8000-00000000f1de", "discord_api_version": "10", "guild_id": guild, "channel_id": channel, "operation": "get_channel_messages", "endpoint": f"/channels/{channel}/messages",
                "pagination": {"before": snowflake(start, first + size), "after": None}, "limit": size, "request_started_at": wire_time(seen - timedelta(seconds=1)), "response_completed_at": wire_time(seen), "http_status": 200,
                "capabilities": {"message_content": True}, "rate_limit": {"limit": 5, "remaining": 5 - p % 5, "reset_after_seconds": 1.5, "bucket": "route-bucket-hash"},
            },
        })
    return out


def load_fixtures(root: str | Store) -> list[dict]:
    """Every envelope document of a folder by name, but the schema; one that is refused is an error."""
    store, out = store_at(root) if isinstance(root, str) else root, []
    for key, _ in store.list():
        if key.endswith(".json") and key.rsplit("/", 1)[-1] != "schema.json":
            env = json.loads(store.get(key))
            if why := refused(env):
                raise ValueError(f"{key}: {why}")
            out.append(env)
    return out
