"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import staged


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(v, root) for each vertex of edges (a, b) but the roots; root: the least vertex of the component.

    Edges may repeat and point either way; null ends and loops are left out. Each step is an aggregation and an
    equi-join, and its result is staged, so lineage stays short; every vertex in turn hangs on the least it has seen.
    """
    e = staged(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        # large star: neighbours above v hang on v's least neighbour
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u <> v").distinct()
        # small star: v and its lesser neighbours hang on the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct(F.col("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = staged(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select("v", F.col("u").alias("root"))
        before = now
    raise RuntimeError(f"components didn't settle in {rounds} rounds")
