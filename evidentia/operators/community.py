"""What is admitted to the archive, how entities relate, and what the last response said of a route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.incremental import TRANSIENT
from . import projection as P


def admit(envelopes: DataFrame, public: DataFrame) -> DataFrame:
    """Envelopes of channels in `public` (channel_id), without transient events. HTTP pages carry their channel in
    provenance; dispatch frames in their data, and those without a channel concern the whole community and stay."""
    frame = F.get_json_object("payload", "$.t")
    channel = F.coalesce(F.col("provenance.channel_id"), F.when(F.col("source_kind") == "gateway", F.get_json_object("payload", "$.d.channel_id")))
    name = "channel"
    while name in envelopes.columns:
        name += "_"
    rows = envelopes.withColumn(name, channel).where(~((F.col("source_kind") == "gateway") & F.coalesce(frame.isin(*TRANSIENT), F.lit(False))))
    open_ = rows.where(F.col(name).isNull() & (F.col("source_kind") == "gateway"))
    known = public.select(F.col("channel_id").alias(name)).distinct()
    return rows.join(known, name, "left_semi").unionByName(open_).select(*envelopes.columns)


def relations(envelopes: DataFrame) -> DataFrame:
    """(message_id, kind, other_id): messages to their channel, attachments, reactions, thread and the message that they
    answer, of every page seen; as a set."""
    kind = "array<struct<id:string,channel_id:string,thread:struct<id:string,parent_id:string>,attachments:array<struct<id:string>>,reactions:array<struct<emoji:struct<id:string,name:string>>>,message_reference:struct<message_id:string>>>"
    m = envelopes.select(F.explode(F.from_json("payload", kind, {"mode": "FAILFAST"})).alias("m"))

    def link(kind: str, value):
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("other_id"))

    one = F.array(link("channel", F.col("m.channel_id")), link("thread", F.col("m.thread.id")), link("thread_parent", F.col("m.thread.parent_id")), link("answers", F.col("m.message_reference.message_id")))
    files = F.transform(F.coalesce("m.attachments", F.array().cast("array<struct<id:string>>")), lambda x: link("attachment", x["id"]))
    signs = F.transform(F.coalesce("m.reactions", F.array().cast("array<struct<emoji:struct<id:string,name:string>>>")), lambda x: link("reaction", F.coalesce(x["emoji"]["id"], x["emoji"]["name"])))
    return m.select(F.col("m.id").alias("message_id"), F.explode(F.concat(one, files, signs)).alias("x")).select("message_id", "x.*").where("other_id is not null").distinct()


def related(canonical: DataFrame, links: DataFrame, kind: str) -> DataFrame:
    """Messages with what they relate to in one way."""
    return canonical.join(links.where(F.col("kind") == kind).select("message_id", "other_id"), "message_id")


def latest_buckets(reports: DataFrame) -> DataFrame:
    """The last report of each route_key by observed_at."""
    return P.best_known(reports, "route_key", ("observed_at",))
