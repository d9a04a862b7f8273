"""Scalar rules as column expressions, and small driver-side helpers."""

from __future__ import annotations

import hashlib
import hmac
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_MS = 1_420_070_400_000  # fixed value: start of the id clock
SNOWFLAKE = r"^[0-9]{1,20}$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,2})?$"
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
UUID7 = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def id_number(c: Column) -> Column:
    """An id as a number; null unless it is 1 to 20 digits within 64 unsigned bits."""
    n = F.when(c.rlike(SNOWFLAKE), c.cast("decimal(20,0)"))
    return F.when(n <= F.lit("18446744073709551615").cast("decimal(20,0)"), n)


def snowflake_ms(c: Column) -> Column:
    return F.call_function("div", id_number(c), F.lit(4194304).cast("decimal(20,0)")) + EPOCH_MS


def snowflake_time(c: Column) -> Column:
    return F.timestamp_millis(snowflake_ms(c))


def snowflake_of(ms: Column, seq: Column) -> Column:
    return F.shiftleft(ms - EPOCH_MS, 22).bitwiseOR(seq.bitwiseAND(0xFFF))


def compare_ids(a: Column, b: Column) -> Column:
    return F.signum(id_number(a) - id_number(b)).cast("int")


def is_uuid7(c: Column) -> Column:
    return c.rlike(UUID7)


def uuid7(ms: int, seed: bytes) -> str:
    """48 bits of time, version and variant, the rest from the seed."""
    r = bytearray(ms.to_bytes(6, "big") + hashlib.sha256(seed).digest()[:10])
    r[6], r[8] = r[6] & 15 | 0x70, r[8] & 63 | 0x80
    h = r.hex()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def classify_status(s: Column) -> Column:
    return F.when(s.between(200, 299), "success").when(s == 401, "unauthorized").when(s == 403, "forbidden").when(s == 404, "not_found").when(s == 429, "rate_limited").when(s.between(400, 499), "client_error").otherwise("server_error")


def counts_as_invalid(status: Column, scope: Column) -> Column:
    return status.isin(401, 403) | ((status == 429) & ~scope.eqNullSafe(F.lit("shared")))


def retry_after_ms(body_s: Column, header_s: Column) -> Column:
    """Body before header before one second; negative and non-finite values don't count."""

    def valid(c: Column) -> Column:
        return F.when((c >= 0) & ~F.isnan(c) & (c < F.lit(float("inf"))), F.ceil(c * 1000))

    return F.coalesce(valid(body_s), valid(header_s), F.lit(1000)).cast("long")


def next_eligible_ms(done_ms: Column, remaining: Column, reset_s: Column) -> Column:
    return F.when((remaining == 0) & reset_s.isNotNull(), done_ms + F.ceil(reset_s * 1000)).otherwise(done_ms).cast("long")


def route_reset_ms(done_ms: Column, reset_s: Column) -> Column:
    return F.when(reset_s.isNotNull(), done_ms + F.ceil(reset_s * 1000)).cast("long")


def backoff_ms(attempt: Column) -> Column:
    return F.least(F.lit(300_000), F.expr("2000") * F.call_function("shiftleft", F.lit(1), F.least(attempt, F.lit(10)).cast("int"))).cast("long")


def header_number(c: Column) -> Column:
    """A finite number, 0 for blanks, null for other text and for null."""
    t = F.trim(c)
    return F.when(t == "", 0.0).when(t.rlike(NUMBER), t.try_cast("double"))


def header_flag(c: Column) -> Column:
    """True for the text true alone."""
    return c.eqNullSafe(F.lit("true"))


def header_scope(c: Column) -> Column:
    return F.when(c.isin("user", "global", "shared"), c)


def instant(c: Column) -> Column:
    """Date, time and zone as a timestamp, digits behind microseconds dropped; null for other text."""
    return F.when(c.rlike(INSTANT), F.try_to_timestamp(F.upper(c)))


def utc_text(c: Column) -> Column:
    """UTC with exactly three digits of seconds."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def payload_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def lines_sha256(ids: Column) -> Column:
    """Identity of a set: its sorted members, each with a line end, hashed. ids is an array."""
    return F.sha2(F.concat(F.array_join(F.array_sort(ids), "\n"), F.lit("\n")), 256)


def cut_text(text: str, most: int = 512) -> str:
    return text if len(text.encode()) <= most else text.encode()[:most].decode("utf-8", "ignore") + "..."


def subject_tokens(key: bytes, subject: Column) -> Column:
    """The keyed token (HMAC-SHA-256, hex) of each subject, from built-in hashes; null for null."""
    block = (key if len(key) <= 64 else hashlib.sha256(key).digest()).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(x ^ pad for x in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, subject.cast("string").cast("binary")), 256))), 256)


def subject_token(key: bytes, subject: str) -> str:
    return hmac.new(key, subject.encode(), hashlib.sha256).hexdigest()


def positive_int(value: str | None, otherwise: int) -> int:
    return int(value) if value and re.fullmatch(r"\d+", value.strip()) and int(value) > 0 else otherwise


def boolean(value: str | None, otherwise: bool) -> bool:
    return otherwise if value is None else value.strip().lower() in ("1", "true", "yes")


def staging_path(location: str, run: str, chunk: str) -> str:
    return f"{location.rstrip('/')}/data/staging/run={run}/chunk={chunk}.parquet"
