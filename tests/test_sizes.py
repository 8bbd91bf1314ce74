"""Steps that must not grow faster than the input: what is broadcast, read whole or made several times."""

import re

from pyspark.sql import functions as F

from blockloom.llm import quality
from blockloom.plans import further, wide
from blockloom.plans.queries import QUERIES, run_of
from blockloom.sources import fixture


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_addresses_are_broadcast(spark, sf):
    """Frames of a row an address aren't sent through the driver, however small Spark thinks that they are."""
    r = run_of(spark, sf)
    for df in (QUERIES["k5_dropped_mapped"](spark, sf), further.checks(r), further.checks(wide.faulty(r))):
        assert not re.search(r"BroadcastHashJoin \[ip#", plan(df))


def test_placements_of_odd_addresses(spark):
    """Repeated, lost, strange and null addresses count as joins would have counted them."""
    part = lambda *ips: spark.createDataFrame([(i,) for i in ips], "ip long")
    r = type("R", (), {"h": part(1, 1, 2, None), "e": part(2, 3, 3), "f": part(2, 9, 4, None), "kept": part(1, 2, 3, 4, 5, None), "members": part(1, 2, 3, 4, 5)})
    got = {x.name: (x.failures, x.passed) for x in further.placements(r).collect()}
    # lost: kept 5 and null, placed 9 and two nulls; more than once: 1, 2, 3 and null
    assert got == {"no_overlap_h_e": (1, False), "no_overlap_h_f": (1, False), "no_overlap_e_f": (1, False), "conservation": (9, False), "no_ghosts": (3, False)}
    none = type("R", (), {n: part() for n in ("h", "e", "f", "kept", "members")})
    assert all(x.failures == 0 and x.passed for x in further.placements(none).collect())


def test_source_counts_distinct_values_once(spark, tmp_path):
    orders = [(k, 1, "O", "1-URGENT") for k in range(1, 6)]
    lines = [(1, 5, 7, 1.0, "R"), (1, 5, 8, 2.0, "A"), (1, 6, 7, 3.0, "N"), (2, None, 7, 1.0, "R"), (2, None, None, 1.0, "R"), (3, 4, None, 2.0, None), (3, 4, None, 2.0, "A"), (4, 1, 1, None, "A")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    made = fixture.source(spark, str(tmp_path))
    got = {r.ip - fixture.BASE: (r.apps, r.manufacturers, r.mobile, r.wifi, r.dna) for r in made.collect()}
    assert got == {1: (2, 2, 1, 1, 3), 2: (0, 1, 2, 0, 2), 3: (1, 0, 0, 1, 2), 4: (1, 1, 0, 1, 1), 5: (0, 0, 0, 0, 0)}
    assert "Expand" not in plan(made)


def test_op10_reads_every_label(spark, monkeypatch):
    """The target is of all trusted documents that don't set the threshold, also of more than 20,000."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 7).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    sums, plain = [], quality.bucket_counts
    monkeypatch.setattr(quality, "bucket_counts", lambda *x: sums.append(int((got := plain(*x)).sum())) or got)
    quality.quality(docs, labels, 0.0)
    assert sums == [docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(quality.FIT)) != 0).count(), 30_000]
