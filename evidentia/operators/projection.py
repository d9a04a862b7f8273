"""From archived envelopes to the best-known state of every message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..schemas import CANONICAL, HTTP_KINDS, KINDS, MESSAGES, PROJECTION_VERSION
from ..scratch import cut

#: Which snapshot of a message wins: edited last (null lowest), seen last, greatest observation id, first place in its page.
ORDER = ("edited_at", "observed_at", "observation_id", "place")


def refuse(rows: DataFrame, why: Column) -> DataFrame:
    """The same rows; the job fails at the first one for which `why` is a text. A filter, so that it holds
    whichever columns are read later."""
    return rows.where(F.when(why.isNotNull(), F.raise_error(why).cast("boolean")).otherwise(True))


def envelope_error(strict: bool = True) -> Column:
    """Why an envelope is refused, null if it isn't."""
    p = F.col("provenance")
    http = F.col("source_kind").isin(*HTTP_KINDS)
    out = (
        F.when(~F.col("envelope_version").eqNullSafe(F.lit("v1")), "envelope_version")
        .when(~F.coalesce(S.is_uuid7(F.col("observation_id")), F.lit(False)), "observation_id")
        .when(~F.coalesce(F.col("source_kind").isin(*KINDS), F.lit(False)), "source_kind")
        .when(F.coalesce(F.col("observed_at").cast("string"), F.lit("")) == "", "observed_at")
        .when(F.coalesce(F.trim("payload"), F.lit("")) == "", "payload")
        .when(http & p.isNull(), "provenance")
    )
    if strict:
        out = (
            out.when(http & ~F.ltrim("payload").startswith("["), "payload_array")
            .when(http & (F.coalesce(p["limit"], F.lit(0)) < 1), "limit")
            .when(http & ~F.coalesce(p["http_status"].between(100, 599), F.lit(False)), "http_status")
            .when(http & F.coalesce(p["capabilities"]["message_content"].isNull(), F.lit(True)), "capabilities")
            .when(http & (p["rate_limit"].isNull() | p["pagination"].isNull()), "rate_limit")
        )
        for k in ("run_id", "guild_id", "channel_id", "operation", "endpoint", "request_started_at", "response_completed_at"):
            out = out.when(http & p[k].isNull(), k)
        out = out.when(http & ~S.is_uuid7(p["run_id"]), "run_id")
        for k in ("guild_id", "channel_id"):
            out = out.when(http & ~p[k].rlike("^[0-9]+$"), k)
        for k in ("discord_api_version", "operation", "endpoint"):
            out = out.when(http & (F.length(p[k]) == 0), k)
        for k in ("limit", "remaining", "reset_after_seconds"):
            out = out.when(http & (p["rate_limit"][k] < 0), f"rate_limit.{k}")
        for k in ("before", "after"):
            out = out.when(http & p["pagination"][k].isNotNull() & ~p["pagination"][k].rlike(r"^[0-9]+$"), f"pagination.{k}")
        for c, k in ((F.col("observed_at"), "observed_at"), (p["request_started_at"], "request_started_at"), (p["response_completed_at"], "response_completed_at")):
            out = out.when(c.isNotNull() & S.instant(c).isNull(), k)
    return out


def validated(envelopes: DataFrame, strict: bool = False) -> DataFrame:
    """The same rows, ids in lower case; the job fails at the first refused one. strict: by the whole wire contract."""
    why = envelope_error(strict)
    return refuse(envelopes, F.when(why.isNotNull(), F.concat(F.lit("refused envelope: "), why))).withColumn("observation_id", F.lower("observation_id"))


def once(rows: DataFrame, key: str = "observation_id", same: str = "payload") -> DataFrame:
    """One row for each key; equal keys that differ in `same` are an error. Maps travel as JSON."""
    maps = [c for c in rows.columns if isinstance(rows.schema[c].dataType, T.StructType)]
    plain = [c for c in rows.columns if c not in (key, *maps)]
    h = S.payload_sha256(F.col(same))
    own = rows.groupBy(key).agg(F.min(F.struct(h.alias("h"), *plain, *[F.to_json(c).alias(c) for c in maps])).alias("x"), F.max(h).alias("last"))
    own = refuse(own, F.when(F.col("x.h") != F.col("last"), F.lit("one observation id, two payloads")))
    return own.select(*[F.col(c) if c == key else F.from_json(f"x.{c}", rows.schema[c].dataType).alias(c) if c in maps else F.col(f"x.{c}").alias(c) for c in rows.columns])


def snapshots(envelopes: DataFrame) -> DataFrame:
    """One row for each message of each page, canonical columns and place in the page. Gateway envelopes, messages
    without id or time, and ids that are no snowflakes are errors."""
    e = refuse(envelopes, F.when(~F.coalesce(F.col("source_kind").isin(*HTTP_KINDS), F.lit(False)), F.lit("not an HTTP observation")))
    m = e.select("observation_id", "source_kind", S.instant(F.col("observed_at")).alias("observed_at"), F.col("provenance.guild_id").alias("guild_id"), F.posexplode(F.from_json("payload", MESSAGES, {"mode": "FAILFAST"})).alias("place", "m"))
    blank, false = F.lit(""), F.lit(False)
    why = (
        F.when(F.coalesce(F.col("m.id"), blank) == "", "message without id")
        .when(S.id_number(F.col("m.id")).isNull(), "message id is no snowflake")
        .when(S.instant(F.col("m.timestamp")).isNull(), "message without time")
        .when(F.col("m.edited_timestamp").isNotNull() & S.instant(F.col("m.edited_timestamp")).isNull(), "time of edit is no time")
        .when(F.col("observed_at").isNull(), "observation without time")
    )
    return refuse(m, why).select(
        F.col("m.id").alias("message_id"),
        F.coalesce("m.channel_id", blank).alias("channel_id"),
        F.coalesce("guild_id", blank).alias("guild_id"),
        F.coalesce("m.author.id", blank).alias("author_id"),
        F.coalesce("m.author.username", blank).alias("author_username"),
        F.coalesce("m.author.bot", false).alias("author_is_bot"),
        F.coalesce("m.content", blank).alias("content"),
        S.instant(F.col("m.timestamp")).alias("created_at"),
        S.instant(F.col("m.edited_timestamp")).alias("edited_at"),
        F.coalesce("m.pinned", false).alias("pinned"),
        F.coalesce("m.type", F.lit(0)).alias("message_type"),
        "observation_id",
        "observed_at",
        "source_kind",
        F.lit(PROJECTION_VERSION).alias("projection_version"),
        S.snowflake_time(F.col("m.id")).alias("snowflake_time"),
        "place",
    )


#: How the pages of a projection version become messages.
RULES: dict[str, Callable[[DataFrame], DataFrame]] = {PROJECTION_VERSION: snapshots}


def best_known(rows: DataFrame, key: str = "message_id", order=ORDER) -> DataFrame:
    """The winning row of each key. Aggregation is partial before the shuffle, so a hot key is no hot task."""
    rank = [(-F.col(c)).alias(c) if c == "place" else F.col(c) for c in order if c in rows.columns]
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*rank)).alias("x")).select(key, "x.*")


def in_order(rows: DataFrame) -> DataFrame:
    """Canonical columns in order, with their field ids."""
    return rows.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in CANONICAL])


def project(envelopes: DataFrame, version: str = PROJECTION_VERSION, strict: bool = False) -> DataFrame:
    """Best-known state of every message, under the rules of a projection version. Unordered: `ordered` sorts it."""
    return in_order(best_known(RULES[version](once(validated(envelopes, strict)))))


def ordered(canonical: DataFrame) -> DataFrame:
    """Rows by message id, as text."""
    return canonical.orderBy("message_id")


def union(*groups: DataFrame) -> DataFrame:
    """All rows of all groups, columns by name."""
    out = groups[0]
    for g in groups[1:]:
        out = out.unionByName(g)
    return out


def reduce(*groups: DataFrame) -> DataFrame:
    """Winners of chunks to winners of all: associative, commutative, idempotent."""
    return in_order(best_known(union(*groups)))


def seen_until(rows: DataFrame, column: Column, at) -> DataFrame:
    """Evidence seen at `at` or before."""
    return rows.where(column <= F.lit(at))


def as_of(envelopes: DataFrame, at) -> DataFrame:
    """State known from evidence seen up to `at`."""
    return project(seen_until(envelopes, S.instant(F.col("observed_at")), at))


def between(envelopes: DataFrame, start, end) -> DataFrame:
    """Evidence seen from `start` up to before `end`, for a replay of a time range."""
    seen = S.instant(F.col("observed_at"))
    return envelopes.where((seen >= F.lit(start)) & (seen < F.lit(end)))


def history(envelopes: DataFrame) -> DataFrame:
    """Every state of every message that was seen, with the observation that saw it."""
    return snapshots(once(validated(envelopes))).drop("place")


def versions(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """rows with their place, from 1, among those of their key."""
    return rows.withColumn("version", F.count("*").over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def lineage(derived: DataFrame, evidence: DataFrame, key: str = "observation_id") -> DataFrame:
    """Each derived row with the evidence that it was taken from."""
    return derived.join(evidence, key)


def raw_pages(envelopes: DataFrame) -> DataFrame:
    """What lineage leads to: observation id, payload and provenance."""
    return envelopes.select(F.lower("observation_id").alias("observation_id"), "payload", "provenance")


def by_author(canonical: DataFrame, author: str, most: int = 500) -> DataFrame:
    """An author's latest messages."""
    return latest(canonical.where(F.col("author_id") == author), ("created_at", "message_id"), most)


def latest(rows: DataFrame, order: tuple[str, ...], most: int = 500) -> DataFrame:
    """The last `most` rows in an order: kept by each task, then merged."""
    return rows.orderBy(*(F.col(c).desc() for c in order)).limit(most)


def holding(rows: DataFrame, text: str, column: str = "content") -> DataFrame:
    """Rows whose text has `text` in it, whatever the case."""
    escaped = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return rows.where(F.col(column).ilike(f"%{escaped}%"))


def chunks(keys: DataFrame, key: str, size: int) -> DataFrame:
    """(key, chunk): contiguous runs of `size` sorted keys. Ranks come from range partitions and their counts, so no
    task sees all keys. The partitions are written once and both are read from that: a range exchange that is
    planned twice may cut at other places."""
    part, n, before = (f"{key}_{x}" for x in ("part", "n", "before"))
    fixed = cut(keys.select(key).repartitionByRange(key).withColumn(part, F.spark_partition_id()), "ranges")
    counts = fixed.groupBy(part).count().withColumn(before, F.coalesce(F.sum("count").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select(part, before)
    ranked = fixed.withColumn(n, F.row_number().over(W.partitionBy(part).orderBy(key)))
    return ranked.join(F.broadcast(counts), part).select(key, F.expr(f"(`{n}` - 1 + `{before}`) div {max(1, size)}").alias("chunk"))  # one row a partition


def identity(rows: DataFrame, *by: str, ids: Column) -> DataFrame:
    """Exact identity of each group: its sorted members, each with a line end, hashed. A group is gathered into one
    row, so this is for groups of a bounded size, as chunks and commit batches are; see also `set_digest`."""
    return rows.groupBy(*by).agg(S.lines_sha256(F.collect_list(ids)).alias("identity"))


def set_digest(rows: DataFrame, *by: str, ids: Column) -> DataFrame:
    """(by, members, total, mixed): order-free digest of each group's members, for groups of any size: two sums of 60
    bits of each member's hash, partial before the shuffle."""
    h = F.sha2(ids.cast("binary"), 256)
    x = rows.select(*by, *[F.conv(F.substring(h, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)").alias(c) for k, c in enumerate(("total", "mixed"))])
    return x.groupBy(*by).agg(F.count("*").alias("members"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("total", "mixed")])


def contiguous(rows: DataFrame, stream: str, seq: str, accepted: Column | None = None) -> DataFrame:
    """(stream, accepted, received): the highest number up to which all are accepted, null where 0 isn't, and the highest
    that was received. Runs end where the next number isn't accepted, which is a join by stream and number: a stream's
    numbers are spread over all tasks."""
    ok = (F.lit(True) if accepted is None else F.coalesce(accepted, F.lit(False))).alias("ok")
    one = rows.select(stream, seq, ok).groupBy(stream, seq).agg(F.max("ok").alias("ok"))
    known = one.where("ok").select(stream, seq)
    ends = known.join(known.select(stream, (F.col(seq) - 1).alias(seq)), [stream, seq], "left_anti").groupBy(stream).agg(F.min(seq).alias("accepted"))
    top = one.groupBy(stream).agg(F.max(seq).alias("received"), F.max(F.when(F.col("ok") & (F.col(seq) == 0), True)).alias("begun"))
    return top.join(ends, stream, "left").select(stream, F.when(F.col("begun"), F.col("accepted")).alias("accepted"), "received")


def activity(canonical: DataFrame, unit: str = "hour") -> DataFrame:
    return canonical.groupBy("channel_id", F.date_trunc(unit, "created_at").alias("bucket")).agg(F.count("*").alias("messages"), F.countDistinct("author_id").alias("speakers"))
