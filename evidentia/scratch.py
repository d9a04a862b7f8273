"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a local folder if the session is local, else an error."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir")
    if not base:
        if not conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/evidentia"


def clear(spark: SparkSession) -> None:
    """Removes all intermediate tables; only while no query runs and no result that reads them is kept."""
    from .sources.store import store_at

    store_at(shared_dir(spark), spark).delete("")


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet and read it again: what it holds is fixed, and lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
