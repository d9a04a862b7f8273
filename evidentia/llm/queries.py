"""The thin queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, lm, media, mixing, quality, secrets, simhash, toxicity, urls, warc
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), simhash.hex16("fp").alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), secrets.fit(spark))
    # outer: else a filter on the array's size is put below, and the scan is made for it once more
    return rows.select("doc_id", F.posexplode_outer("findings")).where("pos is not null").select("doc_id", F.col("pos").alias("place"), "col.value", "col.score", "col.secret")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = urls.judge(table(spark, sf_dir, "pages"))
    return got.withColumnRenamed("id", "page_id")


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_simhash, op2_toxicity, op3_media, op4_decontamination, op5_mixing, op6_secrets, op7_urls, op8_lm, op9_quality, op10_warc)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": mixing.ORACLE_SQL, "op10_warc": warc.ORACLE_SQL}
