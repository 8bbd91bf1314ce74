"""Stage tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session that has none (tests) gets one under /tmp, a cluster must name one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = f"file://{tempfile.mkdtemp(prefix='spark-shared-', dir='/tmp')}"
        spark.conf.set("spark.checkpoint.dir", top)
    return top.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back: later plans start from the table, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
