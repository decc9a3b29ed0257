"""Where a query writes the files that it reads back: the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder below spark.checkpoint.dir; below the warehouse where that is unset and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and spark.sparkContext.master.startswith("local"):
        root = spark.conf.get("spark.sql.warehouse.dir")
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/trendloom/{uuid.uuid4().hex}/{tag}"


def kept(df: DataFrame, tag: str) -> DataFrame:
    """df written once and read again, for what several parts of a job start from."""
    path = folder(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
