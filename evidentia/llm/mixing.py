"""Mixing sources to target weights, with DataFrame operations only.

Sources by code point, null last, weigh 5, 2, 1, repeating. All sizes are shared out by weight;
a target stops at `most` times its source's size and the excess is reshared by weight until none
is above. A source's target is taken as whole rounds over its documents and a last, partial round:
the documents whose hash stays below a threshold. Thresholds come from histograms: tokens summed by
source and hash bucket, and only the bucket where the budget ends is summed again by the next
bits, so nothing is sorted and no group is gathered; a bucket's sum is built by partial sums.

Defined cases: null and empty texts have size 0 and take 0. A null source is a source of its own,
the last one. A null doc_id hashes as ''. Rows with equal ids hash alike and are taken or left
together. If the documents have no words, all targets are 0. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, words_in

WEIGHTS = (5, 2, 1)
BITS = 16  # of a level; three levels


def hash48(c: Column, seed: str) -> Column:
    """The first 48 bits of md5: the same number in any engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(c.cast("string"), F.lit(""))).cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size) with target: shares by weight, capped at most * source_size.

    The capped sources are those with the smallest most * size / weight; with them in that order,
    the first k are capped where the level that the rest would get stays below the next one's cap."""
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int")).cast("long")
    t = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    by = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(W.currentRow, W.unboundedFollowing)
    t = t.withColumn("total", F.sum("source_size").over(W.partitionBy())).withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest))
    t = t.withColumn("free", F.col("level") * F.col("w") < F.col("cap"))
    first = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.currentRow))
    return t.select("source", "source_size", F.when(first.isNull(), F.col("cap").cast("double")).otherwise(F.least(first * F.col("w"), F.col("cap").cast("double"))).alias("target"))


def first_over(sums: DataFrame, place: str) -> DataFrame:
    """sums (source, place, size, left), few places a source: (source, place, rest) of the first place where the running
    sum passes left; rest is what is left before it."""
    run = F.sum("size").over(W.partitionBy("source").orderBy(place))
    over = sums.withColumn("run", run).where(F.col("run") > F.col("left")).groupBy("source").agg(F.min(F.struct("run", place, "size", "left")).alias("x"))
    return over.select("source", F.col(f"x.{place}").alias(place), (F.col("x.left") - F.col("x.run") + F.col("x.size")).alias("rest"))


def thresholds(rows: DataFrame, budgets: DataFrame, levels: int = 48 // BITS) -> DataFrame:
    """rows (source, h, size), budgets (source, left): the greatest h up to which the sizes sum to left at most.

    One pass a level over the rows of the boundary buckets alone. A level's buckets are summed again by their upper half of
    bits, and only the half where the budget ends is looked into, so a source's running sum is over 256 rows at most."""
    state = budgets.select("source", F.col("left"), F.lit(0).cast("long").alias("prefix"))
    width, half = 48, BITS // 2
    for _ in range(levels):
        width -= BITS
        inside = rows.join(state, rows.source.eqNullSafe(state.source)).where(F.shiftright(rows.h, width + BITS) == F.col("prefix")).select(state.source, F.shiftright(rows.h, width).alias("bucket"), "size", "left", "prefix")
        sums = cut(inside.groupBy("source", "bucket").agg(F.sum("size").alias("size"), F.first("left").alias("left")).withColumn("part", F.shiftright("bucket", half)), "mix-sums")
        parts = first_over(sums.groupBy("source", "part").agg(F.sum("size").alias("size"), F.first("left").alias("left")), "part")
        fine = sums.drop("left").join(parts.select(F.col("source").alias("s"), F.col("part").alias("p"), F.col("rest").alias("left")), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select("source", "bucket", "size", "left")
        over = first_over(fine, "bucket")
        # without a bucket over the budget, all rows that are left fit below the old prefix's end
        state = cut(
            state.join(over.withColumnRenamed("source", "s"), state.source.eqNullSafe(F.col("s")), "left").select(
                "source", F.coalesce("rest", "left").alias("left"), F.coalesce("bucket", F.shiftleft(F.col("prefix") + 1, BITS)).alias("prefix")
            ),
            "mix-level",
        )
    return state.select("source", (F.col("prefix") - 1).alias("upto"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: int = 3, seed: str = "mix:") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs."""
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"), hash48(F.col(id_col), seed).alias("h")), "mix")
    goal = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    goal = goal.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("left", F.floor(F.col("target") - F.col("rounds") * F.col("source_size")).cast("long"))
    upto = thresholds(rows.select("source", "h", "size").where("size > 0"), goal.select("source", "left"))
    plan = goal.join(upto.withColumnRenamed("source", "s"), goal.source.eqNullSafe(F.col("s"))).select("source", "source_size", "target", "rounds", "upto")
    plan = plan.withColumnRenamed("source", "s")
    return rows.join(plan, rows.source.eqNullSafe(plan.s)).select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("rounds") + (F.col("h") <= F.col("upto")).cast("long"))).alias("taken"))


ORACLE_SQL = r"""
with rows as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 12) as bigint) as h
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
w as (select *, 3 * source_size as cap, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as w, sum(source_size) over () as total from s),
o as (select *, (total - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
  / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as level from w),
f as (select *, first_value(case when level * w < cap then level end ignore nulls) over (order by cap / w, source nulls last rows between unbounded preceding and current row) as a from o),
g as (select source, source_size, case when a is null then cast(cap as double) else least(a * w, cast(cap as double)) end as target from f),
p as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as rounds from g),
r as (select r.*, p.source_size, p.target, p.rounds, floor(p.target - p.rounds * p.source_size) as rest,
  sum(size) over (partition by r.source order by h range between unbounded preceding and current row) as run
  from rows r join p on r.source is not distinct from p.source)
select doc_id, size, source_size, target, cast(size * (rounds + case when run <= rest then 1 else 0 end) as bigint) as taken from r
"""
