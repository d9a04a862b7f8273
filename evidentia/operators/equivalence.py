"""Comparing two builds of the canonical table."""

from __future__ import annotations

import hashlib
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .projection import set_digest

#: The fields compared, in order.
FIELDS = ("message_id", "channel_id", "guild_id", "author_id", "content", "created_at", "edited_at", "pinned", "observation_id", "observed_at", "projection_version")
#: What one content adopted from one observation is told apart by.
IDENTITY = ("message_id", "observation_id", "content")
SHORT = {"\a": r"\a", "\b": r"\b", "\f": r"\f", "\n": r"\n", "\r": r"\r", "\t": r"\t", "\v": r"\v", "\\": r"\\", '"': r"\""}


def rows(canonical: DataFrame) -> DataFrame:
    """The fields as text: a null time is '', a boolean true or false, times in UTC without trailing zeros."""

    def text(c: str):
        if c.endswith("_at"):
            t = F.to_utc_timestamp(c, F.current_timezone())
            whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
            rest = F.regexp_replace(F.date_format(t, ".SSSSSS"), r"\.?0*$", "")
            return F.coalesce(F.concat(whole, rest, F.lit("Z")), F.lit(""))
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return canonical.select(*[text(c).alias(c) for c in FIELDS])


def quoted(text: str) -> str:
    """In double quotes; control and other unprintable characters escaped, printable ones as they are."""

    def one(c: str) -> str:
        if c in SHORT:
            return SHORT[c]
        if c == " " or unicodedata.category(c)[0] in "LMNPS":
            return c
        n = ord(c)
        return f"\\x{n:02x}" if n < 0x80 else f"\\u{n:04x}" if n < 0x10000 else f"\\U{n:08x}"

    return '"' + "".join(map(one, text)) + '"'


def line(r) -> str:
    return "\t".join(quoted(r[c]) if c == "content" else r[c] for c in FIELDS)


def digest(canonical: DataFrame, most: int = 1_000_000) -> str:
    """Exact digest of the sorted rows, a line each; for more than `most` rows use `digest_any`."""
    if canonical.count() > most:
        raise ValueError("too many rows for the exact digest")
    h = hashlib.sha256()
    for r in rows(canonical).orderBy("message_id").toLocalIterator():
        h.update((line(r) + "\n").encode())
    return h.hexdigest()


def digest_any(canonical: DataFrame) -> DataFrame:
    """One row (members, total, mixed): an order-free digest of the rows, for any number of them."""
    return set_digest(rows(canonical), ids=F.concat_ws("\x1f", *FIELDS))


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (sign, ...) that stand on one side alone; as sets, by one aggregate over both sides."""
    names = left.columns
    side = "side"
    while side in names:
        side += "_"
    both = left.withColumn(side, F.lit(1)).unionByName(right.select(*names).withColumn(side, F.lit(2)))
    return both.groupBy(*names).agg(F.bit_or(side).alias(side)).where(F.col(side) < 3).select(F.when(F.col(side) == 1, "-").otherwise("+").alias("sign"), *names)


def same_identities(left: DataFrame, right: DataFrame) -> bool:
    """Whether both sides hold the same set of message, adopted observation and content."""
    return diff(left.select(*IDENTITY), right.select(*IDENTITY)).isEmpty()
