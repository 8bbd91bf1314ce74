"""Member rows over the orders and lineitem tables: one row per address, with the measures the operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BASE = 16777216
LINES_A_TASK = 200_000
#: Fixed: the measures that blocks sum.
MEASURES = ["reports", "devices", "mobile", "wifi", "vpn", "wired", "abnormal_net", "empty_net", "worktime", "workday", "weekend", "late_night"]


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All addresses with country, operator and measures; is_abnormal is joined later."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # one shuffle by address, for all that follows; as many parts as keep a task's lines few at any size
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lines.count() // LINES_A_TASK + 1)
    lines = lines.select((BASE + F.col("l_orderkey")).alias("ip"), "l_partkey", "l_suppkey", "l_quantity", "l_returnflag").repartition(parts, "ip")
    # counts of distinct values would have each line three times before the shuffle; sorting by one key first makes the sorts by two quick
    first = lambda c: F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.lag(c).over(Window.partitionBy("ip").orderBy(c)))
    lines = lines.sortWithinPartitions("ip").withColumn("p", first("l_partkey")).withColumn("s", first("l_suppkey")).groupBy("ip").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("q"), F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if("p").alias("p"), F.count_if("s").alias("s"),
    )
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("ip", BASE + F.col("o_orderkey")).join(lines, "ip", "left").fillna(0, ["n", "q", "r", "a", "p", "s"])
    k, cust, q, n = (F.col(c) for c in ("o_orderkey", "o_custkey", "q", "n"))
    zone, c, z = F.expr("(o_orderkey div 512) % 3"), F.expr("(o_orderkey div 1536) % 4"), k % 1536
    china = (zone == 0) | ((zone == 1) & (cust % 5 != 0)) | ((zone == 2) & (cust % 6 == 0))
    zero = F.lit(0).cast("long")
    return o.select(
        "ip", F.when(china, "CN").otherwise("OTHER").alias("country"), F.col("o_orderstatus").alias("operator"),
        (q * F.when((c == 3) & z.between(64, 127), 10).otherwise(1)).alias("reports"),
        F.when((zone == 0) & (z < 400), q * F.when(c.isin(1, 2), 3).otherwise(1)).otherwise(n).alias("devices"),
        F.col("r").alias("mobile"), F.col("a").alias("wifi"), zero.alias("vpn"), zero.alias("wired"), zero.alias("abnormal_net"), zero.alias("empty_net"),
        F.expr("q div 3").alias("worktime"), (q - F.expr("q div 4")).alias("workday"), F.expr("q div 4").alias("weekend"), F.expr("q div 8").alias("late_night"),
        F.col("p").alias("apps"), F.col("s").alias("manufacturers"), F.col("r").alias("oaids"), n.alias("android_ids"), F.expr("q div 2").alias("daa"), n.alias("dna"),
        (cust % 14 + 1).alias("active_days"), F.when(F.col("o_orderpriority") == "5-LOW", "unstable").otherwise("stable").alias("stability"),
    )


def abnormal(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    z, c = k % 1536, F.expr("(o_orderkey div 1536) % 4")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").where((k % 41 == 0) | ((c != 2) & z.between(128, 319))).select((BASE + k).alias("ip"))
