"""A corpus pipeline of five stages. Each takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.

Defined cases: null and empty texts are judged by the quality network as one chunk of blanks, are copies of each other for
near-dedup, hold no benchmark item and no secret, and have size 0. Null ids go through every stage; of a class of copies the
row with the smallest id stays, null last. Repeated rows are copies: one stays. A null source is a source of its own in the
mix. Columns that documents don't have, under any name, stay until the last stage. Empty documents give an empty result; an
empty benchmark drops nothing; without labels of both classes the quality stage keeps everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidentia.llm import decontam, mixing, quality, secrets, simhash
from evidentia.llm.common import cut, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.7) go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike to 0.8 stays: the one with the smallest id."""
    return simhash.keep_dissimilar(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets in their texts are replaced."""
    return secrets.redact(docs, secrets.fit(spark))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [("quality", quality_stage), ("simhash", simhash_stage), ("decontamination", decontamination_stage), ("secrets", secrets_stage), ("mixing", mixing_stage)]

#: The network of the first stage has no SQL form; tests compare run() with plain loops over the same stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
