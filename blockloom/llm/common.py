"""Reading tables, staging intermediate tables in the shared folder, shipping the package to executors."""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"
#: Spark removes a query's shuffle files at its end where this is on.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session that names none (tests) gets one under /tmp; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-', dir='/tmp')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage and survives lost executors.

    tidy: the shuffle files of this write go when it has ended, as nothing else reads them.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(TIDY, "false")
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow that gives freed memory back at its end: Spark keeps workers alive between tasks, beside those of later stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
            trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def crc_mod(key: str, n: int):
    """crc32 of the key as decimal text, modulo n."""
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(n))


def ship(spark: SparkSession) -> None:
    """Let executors import this package where their PYTHONPATH doesn't have it, and bound the bytes of an Arrow batch.

    Spark's default of 64 MB a batch means some copies of that in each worker; a smaller one of the session's own stays.
    """
    if spark.conf.get(BATCH) == "67108864b":
        spark.conf.set(BATCH, BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in known or getattr(sc, "_blockloom_shipped", False):
        return
    top = tempfile.mkdtemp(prefix="spark-ship-", dir=os.environ.get("TMPDIR") or None)
    shutil.copytree(os.path.join(root, "blockloom"), os.path.join(top, "tree", "blockloom"), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(top, "blockloom"), "zip", os.path.join(top, "tree")))
    sc._blockloom_shipped = True
