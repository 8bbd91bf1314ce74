"""Contiguous byte-balanced shards from global prefix sums (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.common import partitions, released, staged

OVERHEAD = 16


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number and, within it, the rows and bytes before each row."""
    pid, rows, total = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column("size").to_numpy(zero_copy_only=False)
        before = total + np.cumsum(size) - size
        n = b.num_rows
        new = [np.full(n, pid, np.int64), rows + np.arange(n, dtype=np.int64), before.astype(np.int64)]
        yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, new)], names=[*b.schema.names, "pid", "row_before", "bytes_before"])
        rows, total = rows + n, total + int(size.sum())


def byte_shards(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): rows in key order, cut at equal byte targets.

    size is the text's UTF-8 bytes plus 16. Only this narrow table is sorted: range partitions by key, a running sum in
    each, then the partitions' totals (one row each) give every row its global offset. A row goes to the shard that
    holds the middle of its bytes, so a shard's bytes differ from total/n by at most one row at either edge.
    Null or empty text: size 16, crc32 0. Null keys come first; equal rows keep any order among themselves; an empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(key).alias("key"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    # crc and size stand in the range key, so that many rows of one key still spread over partitions
    parts = narrow.repartitionByRange(partitions(spark), "key", "size", "text_crc32").sortWithinPartitions("key", "size", "text_crc32")
    key_type = dict(narrow.dtypes)["key"]
    placed = staged(parts.mapInArrow(released(_running), f"key {key_type}, size long, text_crc32 long, pid long, row_before long, bytes_before long"), "shards")

    per_part = placed.groupBy("pid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = per_part.select("pid", F.coalesce(F.sum("b").over(w), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("r0"), F.sum("b").over(whole).alias("total"))
    # one row a partition: bounded by the number of partitions
    at = placed.join(F.broadcast(offsets), "pid").select(
        "key", "size", "text_crc32", (F.col("r0") + F.col("row_before")).alias("row"),
        F.least(F.lit(n_shards - 1), F.expr(f"cast(((2 * (b0 + bytes_before) + size) * cast({n_shards} as decimal(20,0))) div (2 * total) as int)")).alias("shard"),
    )
    first = at.groupBy("shard").agg(F.min("row").alias("row0"))
    # one row a shard
    return at.join(F.broadcast(first), "shard").select(F.col("key").alias(key), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("row") - F.col("row0")).alias("slot"))
