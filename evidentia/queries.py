"""Queries on the driver's tables, and the SQL they are compared with.

A row of events is one snapshot of an entity: user_id the entity, ts when it was seen, event_id the observation,
purchases count as edits. Conversations are pages of turns, pages are archive objects, documents a text corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import community, erasure
from .operators import equivalence as E
from .operators import projection as P
from .schemas import ENVELOPE
from .plans.crawl import current_runs
from .sources.archive import key_column
from .sources.catalog import live_files
from .streaming.incremental import dispatches, replay

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def seen(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("user_id", "event_id", "ts", "event_type", F.when(F.col("event_type") == "purchase", F.col("ts")).alias("ed"))


ORDER = ("ed", "ts", "event_id")
WINNERS = "select user_id, event_id, ts, event_type from (select *, row_number() over (partition by user_id order by case when event_type = 'purchase' then ts end desc nulls last, ts desc, event_id desc) as n from events {where}) where n = 1"
MS = "(epoch_us(ts) // 1000)"


def ms(c: str = "ts"):
    return F.unix_millis(F.col(c).cast("timestamp"))


@query(WINNERS.format(where=""))
def current_state(spark, sf):
    return P.best_known(seen(spark, sf), "user_id", ORDER).select("user_id", "event_id", "ts", "event_type")


@query(WINNERS.format(where=""))
def chunked_reduce_state(spark, sf):
    rows = seen(spark, sf).withColumn("chunk", F.col("event_id") % 7)
    part = P.best_known(rows.withColumn("key", F.struct("user_id", "chunk")).drop("chunk"), "key", ORDER)  # each chunk's winners
    return P.best_known(part.drop("key"), "user_id", ORDER).select("user_id", "event_id", "ts", "event_type")


@query(WINNERS.format(where="where ts <= TIMESTAMP '2024-01-15 00:00:00'"))
def historical_state_at_t(spark, sf):
    rows = P.seen_until(seen(spark, sf), F.col("ts"), F.expr("timestamp_ntz'2024-01-15 00:00:00'"))
    return P.best_known(rows, "user_id", ORDER).select("user_id", "event_id", "ts", "event_type")


@query("select distinct event_id, user_id, event_type from events")
def observation_dedup(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return P.once(P.union(e, e), "event_id", "event_type")


def envelopes(spark, sf):
    """Conversations as HTTP observations: a conversation is a page, a turn a message."""
    ident = F.format_string("%08x-0000-7000-8000-%012x", F.col("conv_id"), F.col("conv_id"))
    message = F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("id"), F.col("conv_id").cast("string").alias("channel_id"), F.struct(F.when(F.col("role") == "user", SUBJECT).otherwise("2").alias("id"), F.col("role").alias("username"), F.lit(False).alias("bot")).alias("author"),
        F.col("text").alias("content"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"), F.lit(False).alias("pinned"), F.lit(0).alias("type"), F.col("turn").alias("unknown_member"), F.array(F.struct(F.concat(F.lit("f"), "turn").alias("id"))).alias("attachments"),
    )
    page = table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))), lambda x: x.m)).alias("payload"))  # a page's size
    rest = F.from_json(F.lit('{"guild_id": "1", "operation": "get_channel_messages"}'), ENVELOPE["provenance"].dataType)
    return page.select("conv_id", F.lit("v1").alias("envelope_version"), ident.alias("observation_id"), F.lit("http_backfill").alias("source_kind"), S.utc_text(F.timestamp_seconds(F.col("conv_id") + SEEN)).alias("observed_at"), "payload", rest.withField("channel_id", F.col("conv_id").cast("string")).alias("provenance"))


SUBJECT = "4711000000000000001"
SEEN = 1_706_745_600  # when the first page was seen


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, cast(conv_id as varchar) as channel_id, row_number() over (partition by conv_id order by turn) - 1 as pos, role as author_username, text as content from conversations")
def page_decode_explode(spark, sf):
    rows = P.snapshots(P.once(P.validated(envelopes(spark, sf).drop("conv_id"))))
    return rows.select("message_id", "channel_id", F.col("place").cast("long").alias("pos"), "author_username", "content")


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, printf('%08x-0000-7000-8000-%012x', conv_id, conv_id) as observation_id, text as content, (conv_id * 1000 + turn) // 4194304 + 1420070400000 as ms from conversations")
def canonical_projection(spark, sf):
    c = P.project(envelopes(spark, sf).drop("conv_id"))
    return c.select("message_id", "observation_id", "content", F.unix_millis("snowflake_time").alias("ms"))


@query(f"select event_id, (({MS} - 1420070400000) << 22) + (event_id & 4095) as snowflake, {MS} as ms from events")
def snowflake_roundtrip(spark, sf):
    e = table(spark, sf, "events").select("event_id", S.snowflake_of(ms(), F.col("event_id")).alias("snowflake"))
    return e.withColumn("ms", S.snowflake_ms(F.col("snowflake").cast("string")))


@query("select event_id // 500 as chunk, sha256(string_agg(cast(event_id as varchar), chr(10) order by cast(event_id as varchar)) || chr(10)) as identity from events group by chunk")
def chunk_identity(spark, sf):
    e = table(spark, sf, "events").select(F.expr("event_id div 500").alias("chunk"), F.col("event_id").cast("string").alias("id"))
    return P.identity(e, "chunk", ids=F.col("id"))


HASHED = "count(*) as members, cast(sum(cast('0x' || substr(sha256(l), 1, 15) as bigint)) as varchar) as total, cast(sum(cast('0x' || substr(sha256(l), 16, 15) as bigint)) as varchar) as mixed"


def as_text(digest: DataFrame) -> DataFrame:
    return digest.withColumns({c: F.col(c).cast("string") for c in ("total", "mixed")})


@query(f"select {HASHED} from (select url || '#' || page_id as l from pages)")
def manifest_digest(spark, sf):
    return as_text(P.set_digest(table(spark, sf, "pages"), ids=F.concat_ws("#", "url", "page_id")))


@query("select batch, sha256(string_agg(k, chr(10) order by k) || chr(10)) as identity from (select (row_number() over (order by doc_id) - 1) // 200 as batch, doc_id || '|' || n_chars as k from documents) group by batch")
def commit_batch_identity(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return P.identity(d.join(P.chunks(d, "doc_id", 200), "doc_id").withColumnRenamed("chunk", "batch"), "batch", ids=F.concat_ws("|", "doc_id", "n_chars"))


@query("select k, (row_number() over (order by k) - 1) // 50 as chunk from (select url || '#' || page_id as k from pages where page_id <= 10000000)")
def manifest_chunks(spark, sf):
    return P.chunks(table(spark, sf, "pages").select(F.concat_ws("#", "url", "page_id").alias("k")), "k", 50)


@query("select chunk, count(*) as n, min(doc_id) as first_id, max(doc_id) as last_id from (select doc_id, (row_number() over (order by doc_id) - 1) // 200 as chunk from documents) group by chunk")
def commit_batches(spark, sf):
    return P.chunks(table(spark, sf, "documents"), "doc_id", 200).groupBy("chunk").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("select conv_id, page, min(turn) as next_cursor, count(*) as n, count(*) < 3 as complete from (select conv_id, turn, (row_number() over (partition by conv_id order by turn desc) - 1) // 3 as page from conversations) group by conv_id, page")
def keyset_pages(spark, sf):
    c = table(spark, sf, "conversations").withColumn("n", F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("turn").desc())))
    return c.groupBy("conv_id", F.expr("(n - 1) div 3").alias("page")).agg(F.min("turn").alias("next_cursor"), F.count("*").alias("n"), (F.count("*") < 3).alias("complete"))


@query(f"select event_id, count(*) over w as in_window, min(ms) over w as oldest from (select event_id, user_id, {MS} as ms from events where event_type = 'error') window w as (partition by user_id order by ms range between 599999 preceding and current row)")
def sliding_invalid_budget(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'error'").select("event_id", "user_id", ms().alias("ms"))
    w = W.partitionBy("user_id").orderBy("ms").rangeBetween(-599999, 0)
    return e.select("event_id", F.count("*").over(w).alias("in_window"), F.min("ms").over(w).alias("oldest"))


@query("select conv_id, max(case when ok and turn = n - 1 then turn end) as accepted, max(turn) as received from (select conv_id, turn, ok, count(*) filter (where ok) over (partition by conv_id order by turn) as n from (select *, (conv_id + turn) % 5 <> 3 as ok from conversations)) group by conv_id")
def contiguous_watermark(spark, sf):
    return P.contiguous(table(spark, sf, "conversations"), "conv_id", "turn", F.expr("(conv_id + turn) % 5 <> 3"))


@query("select doc_id, sha256(text) as payload_sha256 from documents")
def payload_sha256(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.payload_sha256(F.col("text")).alias("payload_sha256"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_field_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k long").k.alias("k"))


@query("with a as (select doc_id, lang, n_chars from documents), b as (select case when doc_id % 17 = 0 then -1 - doc_id else doc_id end as doc_id, lang, case when doc_id % 10 = 0 then n_chars + 1 else n_chars end as n_chars from documents) select '-' as sign, * from (select * from a except select * from b) union all select '+' as sign, * from (select * from b except select * from a)")
def symmetric_diff(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    b = a.withColumn("n_chars", F.when(F.col("doc_id") % 10 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))).withColumn("doc_id", F.when(F.col("doc_id") % 17 == 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id")))
    return E.diff(a, b)


@query("select path from (select o_custkey as path, o_orderstatus, row_number() over (partition by o_custkey order by o_orderkey desc) as n from orders) where n = 1 and o_orderstatus <> 'F'")
def referenced_files(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("n"), F.when(F.col("o_orderstatus") == "F", "DELETED").otherwise("ADDED").alias("status"))
    return live_files(o)


@query("select event_type as channel_id, date_trunc('hour', ts) as bucket, count(*) as messages, count(distinct user_id) as speakers from events group by all")
def activity_hourly(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("channel_id"), F.col("ts").alias("created_at"), F.col("user_id").alias("author_id"))
    return P.activity(e).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("select conv_id, count(*) filter (where role <> 'user') as kept, count(*) filter (where role = 'user') > 0 as erased, coalesce(sum(turn) filter (where role <> 'user'), 0)::bigint as unknown_members from conversations group by conv_id")
def erasure_filter_array(spark, sf):
    page = erasure.erase(envelopes(spark, sf), SUBJECT, "run")
    left = F.from_json("payload", "array<struct<unknown_member:long>>", {"mode": "FAILFAST"})
    return page.select("conv_id", F.size(left).cast("long").alias("kept"), "erased", F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x.unknown_member).alias("unknown_members"))


@query("select a as attempt, least(300000, 2000 * (1 << least(a, 10))) as backoff_ms from range(13) t(a)")
def backoff(spark, sf):
    return spark.range(13).select(F.col("id").alias("attempt"), S.backoff_ms(F.col("id")).alias("backoff_ms"))


@query("select event_id, cast(coalesce(case when b >= 0 then ceil(b * 1000) end, case when h >= 0 then ceil(h * 1000) end, 1000) as bigint) as retry_ms from (select event_id, case when event_id % 3 = 0 then value - 20 end as b, case when event_id % 2 = 0 then value end as h from events)")
def retry_after(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("value") - 20).alias("b"), F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("h"))
    return e.select("event_id", S.retry_after_ms(F.col("b"), F.col("h")).alias("retry_ms"))


STATUS = "case cast(event_id % 9 as int) when 0 then 200 when 1 then 204 when 2 then 401 when 3 then 403 when 4 then 404 when 5 then 429 when 6 then 418 when 7 then 500 else 302 end"
SCOPE = "case cast(event_id % 4 as int) when 0 then 'shared' when 1 then 'user' when 2 then 'global' end"


@query(f"select event_id, case when s between 200 and 299 then 'success' when s = 401 then 'unauthorized' when s = 403 then 'forbidden' when s = 404 then 'not_found' when s = 429 then 'rate_limited' when s between 400 and 499 then 'client_error' else 'server_error' end as class, s in (401, 403) or (s = 429 and sc is distinct from 'shared') as invalid from (select event_id, {STATUS} as s, {SCOPE} as sc from events)")
def classify_status(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.expr(STATUS).alias("s"), F.expr(SCOPE).alias("sc"))
    return e.select("event_id", S.classify_status(F.col("s")).alias("class"), S.counts_as_invalid(F.col("s"), F.col("sc")).alias("invalid"))


LIMITS = f"select event_id, {MS} as done, case when event_id % 5 = 0 then 0 else 3 end as remaining, case when event_id % 7 <> 0 then event_id % 1000 / 4.0 end as reset from events"


def limits(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", ms().alias("done"), F.when(F.col("event_id") % 5 == 0, 0).otherwise(3).alias("remaining"), F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 1000) / 4.0).alias("reset"))


@query(f"select event_id, case when remaining = 0 and reset is not null then done + cast(ceil(reset * 1000) as bigint) else done end as next_ms from ({LIMITS})")
def next_eligible(spark, sf):
    return limits(spark, sf).select("event_id", S.next_eligible_ms(F.col("done"), F.col("remaining"), F.col("reset")).alias("next_ms"))


@query(f"select event_id, case when reset is not null then done + cast(ceil(reset * 1000) as bigint) end as reset_at from ({LIMITS})")
def route_bucket(spark, sf):
    return limits(spark, sf).select("event_id", S.route_reset_ms(F.col("done"), F.col("reset")).alias("reset_at"))


@query("select event_id, ts, event_type from events where user_id = 7 order by ts desc, event_id desc limit 20")
def author_history_topn(spark, sf):
    return P.latest(table(spark, sf, "events").where("user_id = 7").select("event_id", "ts", "event_type"), ("ts", "event_id"), 20)


@query("select count(*) as n from documents")
def corpus_count(spark, sf):
    return table(spark, sf, "documents").agg(F.count("*").alias("n"))


@query("select doc_id, n_chars from documents where text ilike '%the%'")
def content_search(spark, sf):
    return P.holding(table(spark, sf, "documents"), "the", "text").select("doc_id", "n_chars")


@query(f"select w.user_id, w.event_id, e.value, e.props from ({WINNERS.format(where='')}) w join events e on w.event_id = e.event_id")
def lineage_drilldown(spark, sf):
    return P.lineage(current_state(spark, sf).select("user_id", "event_id"), table(spark, sf, "events").select("event_id", "value", "props"), "event_id")


@query("select doc_id from documents where doc_id not in (select doc_id from labels where toxic = 1)")
def suppression_anti_join(spark, sf):
    key = b"secret of this query"
    tokens = erasure.mark_suppressed(table(spark, sf, "labels").where("toxic = 1"), key, "doc_id")
    return erasure.suppress(table(spark, sf, "documents").select("doc_id", S.subject_tokens(key, F.col("doc_id")).alias("token")), tokens).select("doc_id")


TIME = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || regexp_replace('.' || strftime({0}, '%f'), '\\.?0*$', '') || 'Z'"
LINE = f"""concat_ws(chr(31), cast(user_id as varchar), event_type, '', cast(user_id as varchar), coalesce(props, ''), {TIME.format("ts")},
    case when event_type = 'purchase' then {TIME.format("ts")} else '' end, case when event_type = 'purchase' then 'true' else 'false' end, cast(event_id as varchar), {TIME.format("ts")}, 'v')"""


@query(f"select {HASHED} from (select {LINE} as l from (select w.*, e.props from ({WINNERS.format(where='')}) w join events e on w.event_id = e.event_id))")
def equivalence_digest(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", F.when(F.col("event_type") == "purchase", F.col("ts")).alias("ed"), "props")
    known, t = P.best_known(e, "user_id", ORDER), F.col("ts").cast("timestamp")
    user = F.col("user_id").cast("string")
    return as_text(
        E.digest_any(
            known.select(
                user.alias("message_id"), F.col("event_type").alias("channel_id"), F.lit("").alias("guild_id"), user.alias("author_id"), F.col("props").alias("content"), t.alias("created_at"), F.col("ed").cast("timestamp").alias("edited_at"),
                (F.col("event_type") == "purchase").alias("pinned"), F.col("event_id").cast("string").alias("observation_id"), t.alias("observed_at"), F.lit("v").alias("projection_version"),
            )
        )
    )


@query("select min(event_id) as oldest from events")
def min_id(spark, sf):
    ids = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"))
    return ids.agg(F.min_by("id", S.id_number(F.col("id"))).cast("long").alias("oldest"))


@query("select event_id, case when event_id % 3 = 0 then 1 when event_id % 3 = 1 then -1 else 0 end as sign from events")
def compare_ids(spark, sf):
    a = F.concat(F.lit("9007199254740"), F.lpad((F.col("event_id") % 3).cast("string"), 3, "9"))
    b = F.when(F.col("event_id") % 3 == 0, F.lit("9007199254740989")).when(F.col("event_id") % 3 == 1, F.lit("9007199254740999")).otherwise(a)
    return table(spark, sf, "events").select("event_id", S.compare_ids(a, b).alias("sign"))


@query("select distinct user_id, event_type from events")
def union_of_groups(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type")
    return P.union(e, e.select("event_type", "user_id")).distinct()  # groups that overlap, columns in any order


@query("select user_id, event_id, count(*) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as version from events")
def snapshot_history(spark, sf):
    return P.versions(seen(spark, sf), "user_id", ("ts", "event_id")).select("user_id", "event_id", "version")


BUDGET = f"""
with recursive e as (select user_id, event_id as id, {MS} as ms, row_number() over (partition by user_id order by {MS}, event_id) as n from events),
f as (
  select user_id, id, ms, n, true as granted, cast(null as bigint) as older, ms as newer from e where n = 1
  union all
  select e.user_id, e.id, e.ms, e.n, older is null or older <= e.ms - 86400000,
    case when older is null or older <= e.ms - 86400000 then newer else older end, case when older is null or older <= e.ms - 86400000 then e.ms else newer end
  from f join e on e.user_id = f.user_id and e.n = f.n + 1)
select user_id, id, ms, granted from f"""


@query(BUDGET)
def budget_replay(spark, sf):
    """A fold: refused requests take no slot. The last two grants are its state."""
    e = table(spark, sf, "events").select("user_id", F.col("event_id").alias("id"), ms().alias("ms"))
    return replay(e, "user_id", 2, 86_400_000)


@query("select event_id, printf('observations/v1/source=%s/%s/%s.json.gz', event_type, strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H'), 'a' || event_id) as key from events")
def archive_key(spark, sf):
    ident = F.concat(F.lit("A"), F.col("event_id").cast("string"))
    return table(spark, sf, "events").select("event_id", key_column(F.col("event_type"), F.col("ts").cast("timestamp"), ident).alias("key"))


@query("""select event_id, case event_id % 8 when 0 then 'envelope_version' when 1 then 'observation_id' when 2 then 'observation_id' when 3 then 'source_kind' when 4 then 'observed_at' when 5 then 'payload' when 6 then 'provenance' end as error from events""")
def envelope_errors(spark, sf):
    k, none = F.col("event_id") % 8, F.lit(None).cast("string")
    good = F.lit("0199A1b2-0000-7000-8000-000000000001")
    p = F.from_json(F.when(k != 6, F.lit("{}")), ENVELOPE["provenance"].dataType)
    rows = table(spark, sf, "events").select(
        "event_id", F.when(k == 0, "v2").otherwise("v1").alias("envelope_version"), F.when(k == 1, F.lit("0199a1b2-0000-4000-8000-000000000001")).when(k == 2, none).otherwise(good).alias("observation_id"), F.when(k == 3, "mail").otherwise("http_reconciliation").alias("source_kind"),
        F.when(k == 4, none).otherwise("2024-01-01T00:00:00Z").alias("observed_at"), F.when(k == 5, " ").otherwise("[]").alias("payload"), p.alias("provenance"),
    )
    return rows.select("event_id", P.envelope_error(strict=False).alias("error"))


@query("select event_id, case when event_id % 4 = 0 then event_id::varchar end as id, event_id % 3 = 0 as uuid7 from events")
def parse_ids(spark, sf):
    n, e = F.col("event_id"), F.col("event_id").cast("string")
    text = F.when(n % 4 == 0, e).when(n % 4 == 1, F.concat(F.lit("+"), e)).when(n % 4 == 2, F.lit("18446744073709551616")).otherwise(F.concat(e, F.lit("e1")))
    ident = F.format_string("%08x-0000-%s000-8000-000000000001", n, F.when(n % 3 == 0, "7").otherwise("4"))
    return table(spark, sf, "events").select("event_id", S.id_number(text).cast("string").alias("id"), S.is_uuid7(ident).alias("uuid7"))


@query("select event_id, case when event_id % 3 < 2 then strftime(ts - interval (case when event_id % 3 = 1 then 2 else 0 end) hour, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' end as seen from events")
def instants(spark, sf):
    t, k = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("event_id") % 3
    text = F.concat(t, F.when(k == 0, "Z").when(k == 1, "+02:00").otherwise(""))  # the last has no zone
    return table(spark, sf, "events").select("event_id", S.utc_text(S.instant(text)).alias("seen"))


@query("select event_id, case event_id % 6 when 0 then 0.0 when 1 then event_id::double when 2 then event_id / 8.0 end as n, event_id % 2 = 0 as flag, case event_id % 4 when 0 then 'user' when 1 then 'global' when 2 then 'shared' end as scope from events")
def header_parse(spark, sf):
    k, e = F.col("event_id") % 6, F.col("event_id")
    text = F.when(k == 0, " ").when(k == 1, F.concat(F.lit(" "), e.cast("string"))).when(k == 2, (e / 8.0).cast("decimal(18,3)").cast("string")).when(k == 3, "NaN").when(k == 4, "Infinity").otherwise("soon")
    scope = F.element_at(F.array(*map(F.lit, ("user", "global", "shared", "other"))), (e % 4 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", S.header_number(text).alias("n"), S.header_flag(F.when(e % 2 == 0, "true").otherwise("True")).alias("flag"), S.header_scope(scope).alias("scope"))


@query("select o_custkey as channel_id, o_orderkey as run_id, o_orderstatus as state from (select *, row_number() over (partition by o_custkey order by o_orderstatus = 'O' desc, o_orderdate desc, o_orderkey desc) as n from orders) where n = 1")
def latest_run(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("channel_id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("state"))
    return current_runs(o, active=("O",)).select("channel_id", "run_id", "state")


@query("select user_id || '/' || event_type as route_key, max(event_id) as observed_at, arg_max(value, event_id) as remaining from events group by route_key")
def route_buckets(spark, sf):
    e = table(spark, sf, "events").select(F.concat_ws("/", "user_id", "event_type").alias("route_key"), F.col("event_id").alias("observed_at"), F.col("value").alias("remaining"))
    return community.latest_buckets(e)


@query("select conv_id from conversations group by conv_id having count(*) > 4")
def admission(spark, sf):
    public = table(spark, sf, "conversations").groupBy(F.col("conv_id").cast("string").alias("channel_id")).count().where("count > 4")
    return community.admit(envelopes(spark, sf), public.select("channel_id")).select("conv_id")


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, unnest(['channel', 'attachment']) as kind, unnest([cast(conv_id as varchar), 'f' || turn]) as other_id from conversations")
def entity_relations(spark, sf):
    return community.relations(envelopes(spark, sf))


def pads(key: bytes) -> tuple[str, str]:
    return tuple(bytes(x ^ pad for x in key.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C))


@query(f"select doc_id, sha256(unhex('{pads(b'key')[1]}') || unhex(sha256(unhex('{pads(b'key')[0]}') || encode(doc_id::varchar)))) as token from documents")
def subject_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.subject_tokens(b"key", F.col("doc_id")).alias("token"))


IN_RANGE = "select cast(conv_id * 1000 + turn as varchar) as message_id, text as content from conversations where {}"


@query(IN_RANGE.format("conv_id >= 20 and conv_id < 60"))
def time_range_replay(spark, sf):
    at = [F.timestamp_seconds(F.lit(SEEN + k)) for k in (20, 60)]
    return P.project(P.between(envelopes(spark, sf).drop("conv_id"), *at)).select("message_id", "content")


@query(IN_RANGE.format("conv_id <= 50"))
def state_as_of(spark, sf):
    return P.as_of(envelopes(spark, sf).drop("conv_id"), F.timestamp_seconds(F.lit(SEEN + 50))).select("message_id", "content")


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, printf('%08x-0000-7000-8000-%012x', conv_id, conv_id) as observation_id, text as content, cast(conv_id * 1000 + turn as varchar) || ' ' || conv_id as raw from conversations")
def lineage_of_messages(spark, sf):
    e = envelopes(spark, sf).drop("conv_id")
    back = P.lineage(P.project(e).select("message_id", "observation_id", "content"), P.raw_pages(e))
    first = F.get_json_object("payload", "$[0].channel_id")  # of the raw page
    return back.select("message_id", "observation_id", "content", F.concat_ws(" ", "message_id", first).alias("raw"))


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, printf('%08x-0000-7000-8000-%012x', conv_id, conv_id) as observation_id from conversations")
def message_history(spark, sf):
    e = envelopes(spark, sf).drop("conv_id")
    return P.history(P.union(e, e)).select("message_id", "observation_id")


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, cast(conv_id as varchar) as channel_id, '1' as guild_id, text as content, '2024-01-01T00:00:00Z' as created_at, '' as edited_at, 'false' as pinned, strftime(to_timestamp(1706745600 + conv_id) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as observed_at, 'http-message-v1' as projection_version from conversations")
def equivalence_rows(spark, sf):
    return E.rows(P.project(envelopes(spark, sf).drop("conv_id"))).drop("author_id", "observation_id")


@query("select true as same, false as other")
def identity_match(spark, sf):
    c = P.project(envelopes(spark, sf).drop("conv_id"))
    return spark.createDataFrame([(E.same_identities(c, P.project(P.union(*[envelopes(spark, sf).drop("conv_id")] * 2))), E.same_identities(c, c.where("message_id > '1'")))], "same boolean, other boolean")


@query("select cast(conv_id * 1000 + turn as varchar) as message_id, text as content from conversations order by message_id limit 500")
def ordered_limit(spark, sf):
    return P.ordered(P.project(envelopes(spark, sf).drop("conv_id"))).select("message_id", "content").limit(500)


@query("""select event_id as sequence, event_type as event, '{"op":0,"t":"' || event_type || '","s":' || event_id || ',"d":{}}' as payload from events where event_type not in ('click', 'error')""")
def gateway_dispatches(spark, sf):
    kind = F.col("event_type")  # clicks stand for transient events, errors for control frames
    frame = F.concat(F.lit('{"op":'), F.when(kind == "error", "11").otherwise("0"), F.lit(',"t":"'), F.when(kind == "click", "TYPING_START").otherwise(kind), F.lit('","s":'), F.col("event_id").cast("string"), F.lit(',"d":{}}'))
    rows = table(spark, sf, "events").select(F.lit("0199a1b2-0000-7000-8000-000000000001").alias("observation_id"), F.lit("2024-01-01T00:00:00Z").alias("observed_at"), frame.alias("frame"), F.lit("i").alias("instance_id"), F.lit("s").alias("session_id"), F.lit(0).alias("shard"), F.lit(1).alias("intents"))
    return dispatches(rows).select("gateway.sequence", "gateway.event", "payload")
