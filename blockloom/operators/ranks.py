"""Exact global ranks without one window over all rows: a running sum over prefix counts, then ranks inside prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.operators import scans


def ranked(df: DataFrame, key: str = "ip", bits: int = 16, out: str = "rank") -> DataFrame:
    """Adds the 1-based rank of each row by a unique key, and the number of rows as `rows_all`.

    The running sum sees one row a prefix (2^16 at most for 32-bit keys); rows themselves are shuffled once, by prefix.
    """
    d = df.withColumn("__p", F.shiftright(key, bits))
    bins = d.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("rows_all"))
    inside = F.row_number().over(Window.partitionBy("__p").orderBy(key))
    return d.withColumn("__r", inside).join(bins, "__p").withColumn(out, F.col("__before") + F.col("__r")).drop("__p", "__r", "__before")


def running(df: DataFrame, key: str, n: str, out: str, everything: str, bits: int = 12) -> DataFrame:
    """Adds the sum of n over all keys up to a row's unique key, and the sum over all rows; a window sees 2^bits keys, or one row a prefix."""
    d = df.withColumn("__p", F.shiftright(key, bits))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    bins = d.groupBy("__p").agg(F.sum(n).alias("__n"))
    bins = bins.select("__p", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias(everything))
    own = F.sum(n).over(Window.partitionBy("__p").orderBy(key))
    return d.withColumn("__own", own).join(bins, "__p").withColumn(out, F.col("__before") + F.col("__own")).drop("__p", "__own", "__before")


def tiles(df: DataFrame, n: int, key: str = "ip", bits: int = 16, out: str = "shard") -> DataFrame:
    """n shards by rank whose sizes differ by at most one, the larger ones first."""
    size, more = F.expr(f"rows_all div {n}"), F.expr(f"rows_all % {n}")
    r = F.col("rank") - 1
    cut = more * (size + 1)
    d = ranked(df, key, bits).withColumns({"__r": r, "__size": size, "__cut": cut})
    shard = F.when(F.col("__r") < F.col("__cut"), F.expr("__r div (__size + 1)")).otherwise(F.expr(f"rows_all % {n} + (__r - __cut) div greatest(__size, 1)"))
    return d.withColumn(out, shard).drop("__r", "__size", "__cut", "rank", "rows_all")


def neighbours(df: DataFrame, targets: DataFrame, reach: int, key: str = "ip", bits: int = 16) -> DataFrame:
    """(target, distance, key) of the `reach` rows before and after each target key that df holds; an equi-join on ranks."""
    at = ranked(df.select(key), key, bits).drop("rows_all")
    own = targets.select(F.col(key).alias("target")).distinct().join(at.withColumnRenamed(key, "target"), "target")
    spread = own.withColumn("distance", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).where("distance <> 0")
    return spread.withColumn("rank", F.col("rank") + F.col("distance")).join(at, "rank").drop("rank")


def assigned(df: DataFrame, bounds: list[int], key: str = "ip", out: str = "shard") -> DataFrame:
    """Adds the number of the half-open range [bounds[i], bounds[i + 1]) that the key falls in, null outside; no join.

    `bounds` is a plan's, one entry a shard.
    """
    at = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key))).cast("long") - 1
    return df.withColumn(out, F.when((F.col(key) >= bounds[0]) & (F.col(key) < bounds[-1]), at))


def percentiles(df: DataFrame, group: str, value: str, wanted: dict[str, float], bits: int = 12, scale: int | None = None) -> DataFrame:
    """(group, one column a name) exact percentiles, interpolated, of a whole-number column; nulls are left out.

    With a scale, values are fractions: they stay as they are, and their buckets are those of value * scale.

    Values are counted first. A running sum over counts by the values' high bits finds the bucket of each wanted rank, and
    only those buckets' values are ranked, each bucket by itself: no task holds a group's values.
    """
    n = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).cast("double" if scale else "long").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("b", F.shiftright((F.col("v") * (scale or 1)).cast("long"), bits))
    buckets = n.groupBy("g", "b").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("g")
    before = F.coalesce(F.sum("n").over(w.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = buckets.withColumns({"before": before, "all": F.sum("n").over(w)})
    ranks_of = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("all") - 1)).alias("at")) for name, q in wanted.items()]))
    ends = buckets.select("g", "b", "before", "n", ranks_of.alias("x")).select("g", "b", "before", "n", "x.name", "x.at")
    ends = ends.select("g", "b", "before", "n", "name", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("r")).distinct().where("r >= before and r < before + n")
    inside = Window.partitionBy("g", "b").orderBy("v")
    placed = n.join(ends.select("g", "b").distinct(), ["g", "b"], "left_semi").withColumn("to", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.select("g", "b", "v", (F.col("to") - F.col("n")).alias("lo"), "to")
    found = ends.select("g", "b", "before", "name", "at", "r").join(placed, ["g", "b"]).where("r - before >= lo and r - before < to")
    part = F.col("at") - F.floor("at")
    value_at = F.sum(F.when(F.floor("at") == F.ceil("at"), F.col("v").cast("double")).when(F.col("r") == F.floor("at"), F.col("v") * (1 - part)).otherwise(F.col("v") * part))
    long = found.groupBy("g", "name").agg(value_at.alias("p"))
    return long.groupBy(F.col("g").alias(group)).agg(*[F.max(F.when(F.col("name") == name, F.col("p"))).alias(name) for name in wanted])


def balanced(df: DataFrame, size: str, key: str, target: int, by: str, out: str = "bucket", bits: int = 16) -> DataFrame:
    """Buckets of about `target` rows within each shard: blocks by size (largest first), cut by running size."""
    # largest first: blocks of one size are a stretch, cut again by their keys' high bits
    first = -F.col(size)
    d = scans.scan(df, [by], [first, F.col(key)], [first, F.shiftright(key, bits)], {"__cum": ("sum", size)})
    d = d.join(df.groupBy(by).agg(F.sum(size).alias("__all")), by)
    return d.withColumn(out, F.expr(f"__cum * ((__all + {target - 1}) div {target}) div (__all + 1) + 1")).drop("__cum", "__all")


def shard_counts(df: DataFrame, bounds: list[int], key: str = "ip") -> list[int]:
    """Rows in each half-open range of the bounds; one pass, one row a range comes back."""
    at = sum(((F.col(key) >= b).cast("int") for b in bounds[1:-1]), F.lit(0))
    found = {r["at"]: r["n"] for r in df.where(F.col(key).between(bounds[0], bounds[-1] - 1)).groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(i, 0) for i in range(len(bounds) - 1)]


def rebalanced(df: DataFrame, bounds: list[int], eps: float = 0.05, rounds: int = 3, key: str = "ip") -> tuple[list[int], list[int]]:
    """(bounds, counts) after at most `rounds` moves of the inner bounds.

    A range is over (+1) or under (-1) when its rows leave the mean by more than eps. Each inner bound moves towards the
    fuller side by 5 % of the shorter of its two ranges, so no range vanishes. A range without rows is an error. Only
    the bounds and one count a range are on the driver.
    """
    bounds = list(bounds)
    for left in range(rounds, -1, -1):
        counts = shard_counts(df, bounds, key)
        if 0 in counts:
            raise ValueError(f"range {counts.index(0)} of the plan has no rows")
        mean = sum(counts) / len(counts)
        load = [(n > mean * (1 + eps)) - (n < mean * (1 - eps)) for n in counts]
        if not left or not any(load):
            break
        for i in range(1, len(bounds) - 1):
            pull = load[i] - load[i - 1]
            step = int(0.05 * min(bounds[i] - bounds[i - 1], bounds[i + 1] - bounds[i]))
            bounds[i] += step * ((pull > 0) - (pull < 0))
    return bounds, counts


def top(df: DataFrame, by: list[str], order: list, k: int, out: str = "place") -> DataFrame:
    """The first k rows of each group in a total order, with their place from 1. k must be below spark.sql.optimizer.windowGroupLimitThreshold.

    The filter on row_number lets Spark keep k rows a group in each task before the shuffle, so what a group sends is k
    rows a task and not its rows.
    """
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(out) <= k)
