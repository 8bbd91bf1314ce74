"""Rules, ranks and run state on small rows, against plain Python."""

import bisect

import pytest
from pyspark.sql import functions as F

from blockloom.operators import ranks, rules
from blockloom.plans.details import QUERIES
from blockloom.plans.queries import run_of
from blockloom.sources import runs


def test_rule_nulls_and_unknown_fields(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None), (3, 9, "b")], "id int, v int, t string")
    hit = lambda rule: [r.id for r in df.where(rules.compile_rule(rule, df.columns)).orderBy("id").collect()]
    assert hit({"field": "v", "op": ">", "value": 4}) == [2, 3]
    assert hit({"field": "t", "op": "in", "value": ["", "b"]}) == [2, 3]
    assert hit({"field": "v", "op": ">=", "by": "id", "bands": [(1, 0), (2, 6), (None, 9)]}) == [1, 3]
    assert hit({"needs": [], "dims": [{"field": "v", "op": ">", "value": 4}, {"field": "id", "op": ">", "value": 2}], "failed": 2}) == [3]
    with pytest.raises(ValueError):
        rules.compile_rule({"field": "other", "op": "=", "value": 1}, df.columns)


def test_funnel_loses_no_rows(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i) for i in range(30)], "id int, v int")
    tags = [("low", {"field": "v", "op": "<", "value": 10}), ("none", {"field": "v", "op": ">", "value": 99}), ("rest", {"field": "id", "op": ">=", "value": 0})]
    got = rules.funnel(df, tags, ["id"]).orderBy("step").collect()
    assert [(r.tag, r["rows"], r.rows_left) for r in got] == [("low", 6, 24), ("none", 0, 24), ("rest", 24, 0)]
    assert rules.funnel(df.limit(0), tags, ["id"]).agg(F.sum("rows")).first()[0] == 0


def test_tiles_and_neighbours(spark):
    keys = [3, 4, 70, 71, 300, 301, 302, 5000, 5001, 9999]
    df = spark.createDataFrame([(k,) for k in keys], "ip long")
    got = {r.ip: r.shard for r in ranks.tiles(df, 3, bits=4).collect()}
    assert [got[k] for k in keys] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert ranks.tiles(df.limit(0), 3).count() == 0
    assert sorted(ranks.tiles(df.where("ip < 70"), 5, bits=4).select("shard").toPandas().shard) == [0, 1]
    near = {(r.target, r.distance): r.ip for r in ranks.neighbours(df, spark.createDataFrame([(3,), (302,), (8,)], "ip long"), 2, bits=4).collect()}
    assert near == {(3, 1): 4, (3, 2): 70, (302, -2): 300, (302, -1): 301, (302, 1): 5000, (302, 2): 5001}


def test_rebalanced(spark, sf):
    got = QUERIES["c6_rebalanced_plan"](spark, sf).orderBy("shard").collect()
    keys = sorted(r.ip for r in run_of(spark, sf).members.select("ip").collect())
    step = (keys[-1] - keys[0]) // 8 + 1
    b = [keys[0] + i * step for i in range(8)] + [keys[-1] + 1]
    for done in range(4):
        n = [bisect.bisect_left(keys, b[i + 1]) - bisect.bisect_left(keys, b[i]) for i in range(8)]
        if done == 3:
            break
        big, small = [x > sum(n) / 8 * 1.05 for x in n], [x < sum(n) / 8 * 0.95 for x in n]
        for i in range(7):
            score = small[i] + big[i + 1] - big[i] - small[i + 1]
            move = int(min(b[i + 1] - b[i], b[i + 2] - b[i + 1]) * 0.05)
            b[i + 1] += move if score > 0 else -move if score < 0 else 0
    assert [(r.ip_start, r.ip_end, r.n) for r in got] == [(b[i], b[i + 1], n[i]) for i in range(8)]
    with pytest.raises(ValueError):
        ranks.rebalanced(run_of(spark, sf).members, [0, 1, keys[-1] + 1])


def test_run_state(spark, tmp_path):
    path = f"file://{tmp_path}/config"
    runs.write_config(spark, path, "a", {"k": 5, "eps": 0.1})
    runs.write_config(spark, path, "b", {"k": 7})
    runs.write_config(spark, path, "a", {"k": 6})
    assert {(r.run_id, r.key, r.value) for r in spark.read.parquet(path).collect()} == {("a", "k", "6"), ("a", "eps", "0.1"), ("b", "k", "7")}
    assert runs.purge_run(spark, path, "a") and not runs.purge_run(spark, path, "a")
    assert spark.read.parquet(path).count() == 1
    made = spark.createDataFrame([("a", 1), ("b", None), ("b", 2)], "run_id string, v int")
    got = runs.readiness(made, ["v"], spark.createDataFrame([("a",), ("b",), ("c",)], "run_id string"))
    assert {(r.run_id, r.state) for r in got.collect()} == {("a", "ready"), ("b", "partial"), ("c", "missing")}
    assert runs.latest_run(spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "run_id string, created_at int")).first()[0] == "b"


@pytest.mark.parametrize("bits", [4, 6, 9, 16])
def test_chunks_change_nothing(spark, bits):
    """Blocks and segments over chunk edges, with few and many chunks, against a plain loop."""
    import random

    from blockloom.operators import segments

    dice = random.Random(2)
    keys = sorted(dice.sample(range(3000), 1200) + list(range(5000, 6500)))
    df = spark.createDataFrame([(k,) for k in keys], "ip long")
    start, want = None, {}
    for i, k in enumerate(keys):
        start = k if i == 0 or k != keys[i - 1] + 1 else start
        want[k] = start
    blocks = segments.islands(df, "ip", bits, out="block")
    assert {r.ip: r.block for r in blocks.collect()} == want
    cuts = sorted(dice.sample(keys, 60))
    frame = spark.createDataFrame([(want[c], c) for c in cuts + cuts[:5]], "block long, cut_ip long")
    got = {r.ip: r.segment for r in segments.cut_members(blocks, frame, "block", "segment", bits).collect()}
    assert got == {k: max([want[k]] + [c for c in cuts if c <= k and want[c] == want[k]]) for k in keys}


def test_percentiles(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(g, int(v)) for g, n in ((0, 1), (1, 2), (2, 1001), (3, 500)) for v in rng.integers(-50_000, 90_000, n)] + [(2, None), (3, 7), (3, 7)]
    got = {r.g: r for r in ranks.percentiles(spark.createDataFrame(rows, "g int, v long"), "g", "v", {"a": 0.0, "b": 0.5, "c": 0.9, "d": 1.0}).collect()}
    for g in range(4):
        want = np.percentile([v for h, v in rows if h == g and v is not None], [0, 50, 90, 100])
        assert [got[g][c] for c in "abcd"] == pytest.approx(want.tolist())


def test_checks_stop_or_warn(spark):
    from blockloom.operators import profiles

    df = spark.range(3)
    assert profiles.enforce(profiles.report([("a", "STOP", df.limit(0)), ("b", "WARN", df)])) == ["b"]
    with pytest.raises(ValueError, match="a"):
        profiles.enforce(profiles.report([("a", "STOP", df), ("b", "WARN", df)]))
