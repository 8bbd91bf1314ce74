"""Counts, means and exact percentiles of many metrics at once, by shard and over all, in long form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.operators import scans

EVERYWHERE = -1


def counted(df: DataFrame, metrics: dict[str, Column], shard: Column) -> DataFrame:
    """(metric, shard, v, n): how often each value stands; null values are left out.

    One pass over df, whatever the number of metrics, combined before the shuffle. Tables of parts of the data add up to
    that of the whole (`merged`), so parts may be counted where and when they are made.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("v")) for m, c in metrics.items()]))
    long = df.select(shard.cast("long").alias("shard"), each.alias("x")).select("x.metric", "shard", "x.v").where("v is not null")
    return long.groupBy("metric", "shard", "v").agg(F.count(F.lit(1)).alias("n"))


def merged(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables).groupBy("metric", "shard", "v").agg(F.sum("n").alias("n"))


def summed_up(counts: DataFrame, wanted: dict[str, float], places: int = 6) -> DataFrame:
    """(metric, shard, stat, value): count, mean, least, most and the wanted percentiles, for each shard and for EVERYWHERE.

    Percentiles interpolate between ranks. A running count over ordered values finds the ranks: values of one binary
    order of magnitude's 256th part are a stretch, so no task orders all values of a metric.
    """
    both = counts.unionByName(counts.withColumn("shard", F.lit(EVERYWHERE).cast("long")).groupBy("metric", "shard", "v").agg(F.sum("n").alias("n")).select(*counts.columns))
    v, n = F.col("v"), F.col("n")
    size = F.when(v == 0, 0).otherwise(F.signum(v) * F.floor((F.log2(F.abs(v)) + 1100) * 256)).cast("long")
    total = both.groupBy("metric", "shard").agg(F.sum(n).alias("all"), F.sum(v * n).alias("sum"), F.min(v).alias("least"), F.max(v).alias("most"))
    at = scans.scan(both, ["metric", "shard"], [v], [size], {"to": ("sum", "n")}).join(total.select("metric", "shard", "all"), ["metric", "shard"])
    ranks = F.array(*[F.struct(F.lit(name).alias("stat"), (F.lit(q) * (F.col("all") - 1)).alias("at")) for name, q in wanted.items()])
    inside = lambda r: (r >= F.col("to") - F.col("n")) & (r < F.col("to"))
    # a percentile is between two ranks, each of which one value holds
    part = lambda x: x["at"] - F.floor(x["at"])
    weight = lambda x: F.when(inside(F.floor(x["at"])), 1 - part(x)).otherwise(0.0) + F.when(inside(F.floor(x["at"]) + 1) & (part(x) > 0), part(x)).otherwise(0.0)
    held = F.explode(F.filter(F.transform(ranks, lambda x: F.struct(x["stat"].alias("stat"), weight(x).alias("w"))), lambda y: y["w"] > 0))
    quantiles = at.select("metric", "shard", "v", held.alias("y")).groupBy("metric", "shard", F.col("y.stat").alias("stat")).agg(F.sum(v * F.col("y.w")).alias("value"))
    simple = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), x.cast("double").alias("value")) for s, x in (("count", F.col("all")), ("mean", F.col("sum") / F.col("all")), ("least", F.col("least")), ("most", F.col("most")))]))
    out = total.select("metric", "shard", simple.alias("x")).select("metric", "shard", "x.*").unionByName(quantiles)
    return out.withColumn("value", F.round("value", places))


def approximate(df: DataFrame, metrics: dict[str, Column], shard: Column, wanted: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """(metric, shard, stat, value) percentiles from sketches that are merged before and after the shuffle.

    A value's rank is off by 1 / accuracy of the rows at most; where values hardly repeat this moves far less than `counted`.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("v")) for m, c in metrics.items()]))
    long = df.select(shard.cast("long").alias("shard"), each.alias("x")).select("x.metric", "shard", "x.v").where("v is not null")
    sketch = F.percentile_approx("v", list(wanted.values()), accuracy).alias("q")
    both = long.groupBy("metric", "shard").agg(sketch).unionByName(long.groupBy("metric").agg(sketch).select("metric", F.lit(EVERYWHERE).cast("long").alias("shard"), "q"))
    named = F.explode(F.arrays_zip(F.array(*[F.lit(f"{s}_approx") for s in wanted]).alias("stat"), F.col("q").alias("value")))
    return both.select("metric", "shard", named.alias("x")).select("metric", "shard", F.col("x.stat").alias("stat"), F.col("x.value").alias("value"))
