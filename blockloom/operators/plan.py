"""Range plans from histograms that get finer where keys crowd."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.operators import ranks
from blockloom.sources.stage import stage

LEVELS = (16, 12, 8, 4)


def bins(df: DataFrame, bound: int, key: str = "ip", levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(start, bits, n): keys counted by their high bits, leaving out `bits` low ones, each bin as coarse as the bound lets it.

    Levels go from coarse to fine: a bin of more than `bound` keys is cut at the next one; those of the last level stay.
    Keys are aggregated once, at the finest level; coarser counts are sums of these.
    """
    if list(levels) != sorted(set(levels), reverse=True):
        raise ValueError("levels go from coarse to fine")
    fine = levels[-1]
    counts = stage(df.where(F.col(key).isNotNull()).groupBy(F.shiftright(key, fine).alias("fine")).agg(F.count(F.lit(1)).alias("n")), "bins")
    open_, out = counts, None
    for bits in levels:
        here = open_.withColumn("p", F.shiftright("fine", bits - fine))
        whole = here.groupBy("p").agg(F.sum("n").alias("n"))
        done = (whole if bits == fine else whole.where(F.col("n") <= bound)).select(F.shiftleft("p", bits).alias("start"), F.lit(bits).alias("bits"), "n")
        out = done if out is None else out.unionByName(done)
        if bits != fine:
            open_ = here.join(whole.where(F.col("n") > bound).select("p"), "p", "left_semi").select("fine", "n")
    return out


def plan(df: DataFrame, shards: int, eps: float = 0.05, key: str = "ip", levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(shard, ip_start, ip_end, n): half-open ranges of about equal counts, the last one ending at the greatest key + 1.

    Bins hold at most eps of a shard's share where levels allow it, so shards differ by that much. A shard that no bin
    falls in is absent; `checks` finds it. One row a shard.
    """
    total, last = df.agg(F.count(key), F.max(key)).first()
    if not total:
        return df.sparkSession.createDataFrame([], "shard long, ip_start long, ip_end long, n long")
    each = stage(bins(df, max(1, int(total / shards * eps)), key, levels), "plan-bins")
    at = ranks.running(each, "start", "n", "cum", "all", bits=16)
    found = at.groupBy(F.expr(f"((cum - 1) * {shards}) div all").alias("shard")).agg(F.min("start").alias("ip_start"), F.sum("n").alias("n"))
    rows = found.orderBy("shard").collect()  # one row a shard
    ends = [r.ip_start for r in rows[1:]] + [last + 1]
    return df.sparkSession.createDataFrame([(r.shard, r.ip_start, e, r.n) for r, e in zip(rows, ends, strict=True)], "shard long, ip_start long, ip_end long, n long")


def bounds(made: DataFrame) -> list[int]:
    """The plan's starts and its end, for `ranks.assigned` and `dealt`."""
    rows = made.orderBy("shard").collect()  # one row a shard
    return [r.ip_start for r in rows] + [r.ip_end for r in rows[-1:]]


def dealt(df: DataFrame, ends: list[int], key: str = "ip", out: str = "shard") -> DataFrame:
    """df in one partition for each range, in the plan's order; rows outside are refused by a null shard in the last one."""
    n = len(ends) - 1
    return ranks.assigned(df, ends, key, out).repartitionById(n, F.coalesce(F.col(out), F.lit(n - 1)).cast("int"))


def checks(made: DataFrame, shards: int) -> DataFrame:
    """One row: whether all shards are there, none is empty, ranges join up, and there are rows for all."""
    rows = made.withColumn("next", F.lead("ip_start").over(ranks.Window.orderBy("shard")))  # one row a shard
    joined = F.coalesce(F.bool_and(F.col("next").isNull() | (F.col("next") == F.col("ip_end"))), F.lit(False))
    return rows.agg((F.count(F.lit(1)) == shards).alias("all_shards"), (F.coalesce(F.min("n"), F.lit(0)) > 0).alias("none_empty"), joined.alias("joined"), (F.coalesce(F.sum("n"), F.lit(0)) >= shards).alias("enough_rows"))
