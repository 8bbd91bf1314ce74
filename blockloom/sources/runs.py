"""Output tables by run and shard: writes that replace, purges, and the state of runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_shards(df: DataFrame, path: str) -> None:
    """Write df (with run_id and shard_id) so that each of its (run, shard) partitions is replaced and no other is touched.

    One task writes a partition's rows of one shard: rows are dealt by run and shard first. Running it twice leaves the same table.
    """
    df.repartition("run_id", "shard_id").write.partitionBy("run_id", "shard_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def purge_run(spark: SparkSession, path: str, run_id: str) -> bool:
    """Delete one run's partitions; false if there were none. Other runs' files are not read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"run_id={run_id}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def latest_run(df: DataFrame, created: str = "created_at") -> DataFrame:
    """The run created last; of runs created together, the greatest id."""
    return df.agg(F.max_by("run_id", F.struct(created, "run_id")).alias("run_id"))


def readiness(df: DataFrame, required: list[str], runs: DataFrame | None = None) -> DataFrame:
    """Per run: rows, rows with all required columns, and missing / partial / ready. Runs of `runs` without rows are missing."""
    full = F.lit(True)
    for c in required:
        full = full & F.col(c).isNotNull()
    out = df.groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(full).alias("complete"))
    if runs is not None:
        out = runs.select("run_id").distinct().join(out, "run_id", "left").fillna(0, ["rows", "complete"])
    state = F.when(F.col("rows") == 0, "missing").when(F.col("complete") < F.col("rows"), "partial").otherwise("ready")
    return out.withColumn("state", state)


def write_config(spark: SparkSession, path: str, run_id: str, values: dict) -> None:
    """A run's settings as rows (run_id, key, JSON value); settings written before are kept where `values` has no such key."""
    made = spark.createDataFrame([(k, json.dumps(v, sort_keys=True)) for k, v in values.items()], "key string, value string").withColumn("run_id", F.lit(run_id))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        old = spark.read.schema("key string, value string, run_id string").parquet(path).where(F.col("run_id") == run_id)
        kept = old.join(made.select("key"), "key", "left_anti").select("key", "value").collect()  # settings of one run
        made = made.unionByName(spark.createDataFrame(kept, "key string, value string").withColumn("run_id", F.lit(run_id)))
    made.coalesce(1).write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
