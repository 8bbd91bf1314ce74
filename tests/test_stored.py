"""Stored runs and their repair, run states, rule packs, field configurations, adaptive plans and scans, on small rows."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from blockloom.operators import fields, packs, plan, ranks, scans, statistics, summaries
from blockloom.plans import further, repair
from blockloom.plans.run import Config, run_pipeline
from blockloom.sources import wide
from blockloom.sources.fixture import MEASURES
from blockloom.sources.store import Store

DAY = datetime.datetime(2024, 5, 1)


def members(spark, ips, dense=()):
    """Rows of one country; addresses in `dense` have many devices."""
    extra = ["apps", "manufacturers", "daa", "dna", "oaids", "android_ids"]
    rows = [(i, "CN", "x", *[(400 if i in dense else 2) if m in ("devices", "reports") else 1 for m in MEASURES], *[1] * len(extra)) for i in ips]
    return spark.createDataFrame(rows, f"ip long, country string, operator string, {', '.join(f'{m} long' for m in [*MEASURES, *extra])}")


def tables(store, run_id):
    out = {}
    for t in repair.KEYS:
        df = store.read(t, run_id)
        keep = sorted(c for c in df.columns if c != "run_id")
        out[t] = sorted((tuple(r) for r in df.select(*keep).collect()), key=str)
    return out


def test_repair_in_part(spark, tmp_path):
    """A repaired store has the rows of a full run under the stricter rule; files of shards out of reach are the same ones."""
    bits = 8
    # shard 0: a large block of 100; 1 and 2: a chain of atoms over their edge, with a dense block of 20 next to it; 5: residue alone; 7: a small dense block
    h_large, h_small = range(0, 100), range(512 - 96, 512 - 76)
    chain = [i for i in range(512 - 64, 512 + 96)]
    ips = [*h_large, *h_small, *chain, *[1280 + 3 * i for i in range(20)], *range(1792, 1812)]
    dense = {*h_large, *h_small, *range(1792, 1812)}
    source, none = members(spark, ips, dense), spark.createDataFrame([], "ip long")
    weak, strict = Config(shard_bits=bits, chunk_bits=6, h_tiers=("small", "medium", "large", "xlarge")), Config(shard_bits=bits, chunk_bits=6, h_tiers=("small", "medium", "large", "xlarge"), h_least_valid=50)
    store, full = Store(spark, f"file://{tmp_path}/weak"), Store(spark, f"file://{tmp_path}/strict")
    repair.store_run(run_pipeline(source, none, weak), store, "a")
    repair.store_run(run_pipeline(source, none, strict), full, "a")
    store.write("h", store.read("h", "a").drop("run_id", "shard_id"), "other", repair.shard_of("h", bits))
    files = {t: set(store.read(t, "a").inputFiles()) for t in repair.KEYS}
    found = repair.scope(store, "a", F.expr("valid_cnt < 50"), strict)
    assert found.blocks.count() == 2 and found.members.count() == 40
    repair.rebuild(store, "a", found, strict)
    assert found.shards == [1, 2, 7]  # 2 holds no failing block, but the chain goes on there
    assert tables(store, "a") == tables(full, "a")
    clean = lambda names: {f for f in names if not any(f"shard_id={s}/" in f for s in found.shards) and "run_id=a" in f}
    for t in repair.KEYS:
        assert clean(store.read(t, "a").inputFiles()) == clean(files[t])
    assert store.read("h", "other").count() == len(h_large) + 40  # other runs stay
    again = repair.scope(store, "a", F.expr("valid_cnt < 50"), strict)
    assert again.shards == []
    repair.rebuild(store, "a", again, strict)
    assert tables(store, "a") == tables(full, "a")


def test_repair_random(spark, tmp_path):
    dice = random.Random(4)
    ips = sorted({i + s for s in (dice.randrange(0, 3000) for _ in range(25)) for i in range(dice.randrange(5, 90))})
    dense = {i for i in ips if (i // 50) % 3 == 0}
    source, none = members(spark, ips, dense), spark.createDataFrame([(i,) for i in ips if i % 11 == 0], "ip long")
    tiers = ("small", "medium", "large", "xlarge")
    weak, strict = (Config(shard_bits=8, chunk_bits=6, h_tiers=tiers, h_least_valid=n, e_atom_least=9) for n in (4, 60))
    store, full = Store(spark, f"file://{tmp_path}/weak"), Store(spark, f"file://{tmp_path}/strict")
    repair.store_run(run_pipeline(source, none, weak), store, "a")
    repair.store_run(run_pipeline(source, none, strict), full, "a")
    found = repair.scope(store, "a", F.expr("valid_cnt < 60"), strict)
    assert found.shards
    repair.rebuild(store, "a", found, strict)
    assert tables(store, "a") == tables(full, "a")


def test_run_states(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    f = spark.createDataFrame([(1, "0.0.0.1", 3, 4), (300, "0.0.1.44", None, 4)], "ip long, address string, reports long, devices long")
    for i, name in enumerate(("1", "2", "3")):  # ids that look like numbers stay text
        store.register(name, DAY + datetime.timedelta(days=i))
    assert store.resolve() == store.resolve("latest") == "3" and store.resolve("1") == "1"
    store.write("f_summary", f.where("reports is not null"), "1", F.shiftright("ip", 8))
    store.write("f_summary", f, "2", F.shiftright("ip", 8))
    got = {(r.run_id, r.lib): (r.total, r.ready, r.state, r.fallback) for r in store.summary_states().collect()}
    assert got["1", "f"] == (1, 1, "ready", None) and got["2", "f"] == (2, 1, "partial", "1") and got["3", "f"] == (0, 0, "missing", "1") and got["3", "h"] == (0, 0, "missing", None)
    flags = {r.run_id: (r.f_ready, r.h_ready, r.all_passed, r.bundle_ready, r.preferred) for r in store.run_list().collect()}
    assert flags["1"] == (True, False, False, False, False) and flags["2"][0] is False and len(flags) == 3
    assert Store(spark, f"file://{tmp_path}/none").spark is spark
    # the same shard again: replaced, not added
    store.write("f_summary", f.where("ip = 1"), "2", F.shiftright("ip", 8))
    assert store.read("f_summary", "2").count() == 2 and store.read("f_summary", "2", [0]).count() == 1
    store.replace("f_summary", f.where("ip = 300"), "2", F.shiftright("ip", 8), [0, 1])
    assert [r.ip for r in store.read("f_summary", "2").collect()] == [300]


def test_packs(spark):
    table = lambda *rows: spark.createDataFrame([(i, n, lib, up, json.dumps(rules)) for i, n, lib, up, rules in rows], packs.SCHEMA)
    rule = lambda m, op, v: {"metric": m, "op": op, "val": v}
    three = table((1, "a", "H", None, [rule("v", ">", 3)]), (2, "b", "H", 1, [rule("v", "<", 9)]), (3, "c", "H", 2, [rule("t", "in", ["x", ""])]), (4, "e", "E", None, []))
    assert [(r["name"], r.depth, r.source_id) for r in packs.resolved(three).orderBy("name", "depth").collect()] == [("a", 0, 1), ("b", 0, 2), ("b", 1, 1), ("c", 0, 3), ("c", 1, 2), ("c", 2, 1), ("e", 0, 4)]
    df = spark.createDataFrame([(1, 5, "x"), (2, 10, "x"), (3, None, "x"), (4, 4, None), (5, 4, "y")], "id int, v int, t string")
    got = sorted((r.pack, r.id) for r in packs.matches(df, three, "H", "id").collect())
    assert got == [("a", 1), ("a", 2), ("a", 4), ("a", 5), ("b", 1), ("b", 4), ("b", 5), ("c", 1), ("c", 4)]
    assert packs.matches(df, three, "E", "id").count() == 5 and packs.matches(df, three, "F", "id").count() == 0
    for bad, said in (
        (table((1, "a", "H", 2, []), (2, "b", "H", 3, []), (3, "c", "H", 1, [])), "its own ancestor"), (table((1, "a", "H", 1, [])), "its own ancestor"),
        (table((1, "a", "H", 2, []), (2, "b", "H", 3, []), (3, "c", "H", 2, [])), "its own ancestor"), (table((1, "a", "H", 7, [])), "no parent"), (table((1, "a", "H", 2, []), (2, "b", "E", None, [])), "is for E"),
    ):
        with pytest.raises(ValueError, match=said):
            packs.resolved(bad)
    with pytest.raises(ValueError, match="unknown field"):
        packs.matches(df, table((1, "a", "H", None, [rule("none", ">", 1)])), "H", "id")


def test_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, 6, 0), (2, None, 4), (3, 9, 2)], "a int, b int, c int")
    made = lambda fields_, computed: json.dumps({"library": "h", "fields": fields_, "computed_columns": computed})
    col = lambda n, a, op, b: {"name": n, "fieldA": a, "op": op, "fieldB": b}
    path = tmp_path / "config.json"
    path.write_text(made([{"name": "b", "keep": False}, {"name": "a", "keep": True}], [col("q", "b", "/", "c"), col("s", "q", "+", 1), col("p", "a", "*", "c"), col("d", "a", "-", "b")]))
    out = fields.project(df, path.read_text())
    assert out.columns == ["a", "c", "q", "s", "p", "d"]
    assert [tuple(r) for r in out.orderBy("a").collect()] == [(1, 0, None, None, 0, -5), (2, 4, None, None, 8, None), (3, 2, 4.5, 5.5, 6, -6)]
    assert fields.project(df, "{}").columns == df.columns
    for bad, said in (
        (made([{"name": "z", "keep": True}], []), "unknown fields"), (made([{"name": "a"}, {"name": "a"}], []), "twice"), (made([], [col("a", "b", "+", "c")]), "there already"),
        (made([], [col("x", "b", "%", "c")]), "unknown operation"), (made([], [col("x", "b", "+-", "c")]), "unknown operation"), (made([], [col("x", "y", "+", "c")]), "unknown field"), (made([], [col("x", "x", "+", "c")]), "unknown field"), ("{", "not a configuration"),
    ):
        with pytest.raises(ValueError, match=said):
            fields.project(df, bad)


def test_adaptive_plan(spark):
    dice = random.Random(6)
    keys = sorted({dice.randrange(0, 1 << 20) for _ in range(400)} | set(range(70_000, 72_000)) | {1 << 30})
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "ip long")
    made = {r.start: (r.bits, r.n) for r in plan.bins(df, 100).collect()}
    assert sum(n for _, n in made.values()) == len(keys) and all(n <= 100 or bits == 4 for bits, n in made.values())
    for start, (bits, n) in made.items():
        assert n == sum(start <= k < start + (1 << bits) for k in keys) and start % (1 << bits) == 0
        if bits < 16:  # its parent was too large
            up = {12: 16, 8: 12, 4: 8}[bits]
            assert sum(k >> up == start >> up for k in keys) > 100
    p = plan.plan(df, 6)
    rows = p.orderBy("shard").collect()
    assert rows[-1].ip_end == (1 << 30) + 1 and all(a.ip_end == b.ip_start for a, b in zip(rows, rows[1:]))
    assert [r.n for r in rows] == [sum(r.ip_start <= k < r.ip_end for k in keys) for r in rows] and max(r.n for r in rows) <= len(keys) / 6 * 1.1
    assert tuple(plan.checks(p, 6).first()) == (True, True, True, True) and plan.checks(p.where("shard <> 2"), 6).first().joined is False
    ends = plan.bounds(p)
    parts = plan.dealt(df.where("ip is not null"), ends).withColumn("part", F.spark_partition_id())
    assert parts.where("part <> shard").count() == 0 and parts.count() == len(keys)
    assert {r.shard: r["count"] for r in ranks.assigned(df, ends).where("shard is not null").groupBy("shard").count().collect()} == {r.shard: r.n for r in rows}
    assert plan.plan(df.limit(0), 4).count() == 0 and plan.bounds(plan.plan(df.limit(0), 4)) == []
    with pytest.raises(ValueError):
        plan.bins(df, 5, levels=(8, 12))


@pytest.mark.parametrize("bits", [4, 6, 9, 16])
def test_scan(spark, bits):
    """Running aggregates by stretches are those of one pass, for any length of stretch."""
    dice = random.Random(bits)
    rows = [(g, k, dice.choice([None, 1, 2, 5, -3])) for g in ("a", "b", None) for k in sorted(dice.sample(range(3000), 150))]
    df = spark.createDataFrame(rows, "g string, k long, v int").where("g is not null")
    steps = {"total": ("sum", "v"), "most": ("max", "v"), "least": ("min", "v"), "latest": ("last", "v")}
    got = sorted(map(tuple, scans.scan(df, ["g"], [F.col("k")], [F.shiftright("k", bits)], steps).select("g", "k", *steps).collect()))
    want, now = [], {}
    for g, k, v in (r for r in rows if r[0]):
        seen = now.setdefault(g, [])
        seen += [v] if v is not None else []
        want.append((g, k, *([sum(seen), max(seen), min(seen), seen[-1]] if seen else [None] * 4)))
    assert got == sorted(want)
    assert scans.scan(df.limit(0), ["g"], [F.col("k")], [F.shiftright("k", bits)], steps).count() == 0


def test_wide_fields(spark):
    """Text in, typed fields out; what isn't a number is counted, and a row without a key is kept apart."""
    columns = [c for _, c, _ in wide.FIELDS]
    assert len(columns) == len(set(columns)) == 63
    row = lambda **known: tuple(known.get(n) for n, _, _ in wide.FIELDS)
    rows = [row(ip_long="5", reports="7", apps="x", wifi_device_ratio="0.5"), row(ip_long="", reports="1"), row(ip_long=None, devices="1e"), row(ip_long="6", maker_risk_state="2.5", reports="9999999999999999999999"), row(ip_long="7")]
    made = wide.typed(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).withColumn("another", F.lit(1)))
    assert {r.field: r.n for r in wide.rejects(made).collect()} == {"apps": 1, "ip_long": 1, "row": 2, "devices": 1, "maker_risk_state": 1, "reports": 1}
    assert [(r.ip_long, r.reports, r.wifi_device_ratio) for r in wide.kept(made).orderBy("ip_long").collect()] == [(5, 7, 0.5), (6, None, None), (7, None, None)]
    members_ = wide.as_members(made)
    assert {"ip", "mobile", "late_night", "ssids"} <= set(members_.columns) and members_.where("reports is null or mobile is null").count() == 0
    assert wide.rejects(made.limit(0)).count() == 0
    with pytest.raises(ValueError, match="lacks"):
        wide.typed(spark.createDataFrame([(1,)], "ip_long int"))


def test_shares(spark):
    """Rounded half up as decimals, with bounds and what stands over 0."""
    df = spark.createDataFrame([(1, 8), (5, 1000), (1005, 1000), (3, 0), (0, 5), (10**12, 1)], "a long, b long")
    got = [tuple(r) for r in df.select(summaries.share("a", "b", 2).alias("x"), summaries.share("a", "b", 2, 100, 99.9999, None).alias("y")).collect()]
    assert got == [(0.13, 12.5), (0.01, 0.5), (1.01, 99.9999), (0.0, None), (0.0, 0.0), (1e12, 99.9999)]


def test_statistics(spark):
    """Percentiles of any values, in parts and whole, and near those of sketches."""
    dice = random.Random(8)
    rows = [(i % 3, dice.choice([0.0, 1e-9, 0.5, 1 / 3, -2.5, 7.0, 1e12, dice.random(), dice.gauss(0, 50)]), i if i % 7 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "s int, x double, y int")
    metrics, wanted = {"x": F.col("x"), "y": F.col("y")}, {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    whole = statistics.counted(df, metrics, F.col("s"))
    got = {(r.metric, r.shard, r.stat): r.value for r in statistics.summed_up(whole, wanted, 9).collect()}
    for m, at in (("x", 1), ("y", 2)):
        for s in (0, 1, 2, -1):
            values = sorted(r[at] for r in rows if r[at] is not None and s in (-1, r[0]))
            for name, q in wanted.items():
                place = q * (len(values) - 1)
                lo = int(place)
                hi = min(lo + 1, len(values) - 1)
                assert got[m, s, name] == pytest.approx(values[lo] + (values[hi] - values[lo]) * (place - lo), abs=1e-8)
            assert got[m, s, "count"] == len(values) and got[m, s, "mean"] == pytest.approx(sum(values) / len(values))
    parts = statistics.merged(*(statistics.counted(df.where(F.col("s") == i), metrics, F.col("s")) for i in range(3)))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    near = {(r.metric, r.shard, r.stat): r.value for r in statistics.approximate(df, metrics, F.col("s"), wanted).collect()}
    assert near["y", -1, "p50_approx"] == pytest.approx(got["y", -1, "p50"], abs=2) and len(near) == 2 * 4 * 4
    assert statistics.summed_up(whole.limit(0), wanted).count() == 0


def test_top(spark):
    df = spark.createDataFrame([(g, v) for g in ("a", "b") for v in range(50)], "g string, v int")
    out = ranks.top(df, ["g"], [F.desc("v")], 3)
    assert sorted((r.g, r.v, r.place) for r in out.collect()) == [(g, 49 - i, i + 1) for g in ("a", "b") for i in (2, 1, 0)]
    assert "WindowGroupLimit" in (text := out._jdf.queryExecution().executedPlan().toString()) and ", Partial" in text  # before the shuffle too


def test_gate_on_own_tables(spark):
    """The gate, the plan and the shards of a run over any members; the number of shards is the configuration's."""
    ips = [*range(1000, 1400), *range(5000, 5100), *range(9000, 9700, 7)]
    r = run_pipeline(members(spark, ips, set(range(1000, 1300))), spark.createDataFrame([(i,) for i in ips if i % 13 == 0], "ip long"), Config(shards=3, chunk_bits=6))
    got = {x["name"]: x for x in further.checks(r).collect()}
    assert len(got) == 12 and all(x.passed for n, x in got.items() if n not in ("empty_sides", "shards_complete"))
    assert got["plan_ids"].passed and further.research._plan(r).count() == 3
    assert further.checks(run_pipeline(members(spark, ips), spark.createDataFrame([], "ip long"), Config(shards=500))).where("name = 'plan_ids'").first().passed is False


def test_shards_that_share_a_folder(spark, tmp_path):
    """Shards dealt to few folders are replaced one by one, a new Store finds them, and a repair gives the same tables."""
    store = Store(spark, f"file://{tmp_path}/few")
    store.lay_out("a", 0, 99, folders=4)
    rows = lambda ips, v: spark.createDataFrame([(i, v) for i in ips], "ip long, v string")
    store.write("t", rows(range(0, 100), "old"), "a", F.col("ip"))
    assert len(store.read("t", "a").inputFiles()) == 4
    store = Store(spark, store.path)
    store.write("t", rows([3, 40], "new"), "a", F.col("ip"))
    store.replace("t", rows([7], "new"), "a", F.col("ip"), [7, 8, *range(64, 100)])
    got = {r.shard_id: r.v for r in store.read("t", "a").collect()}
    assert got == {i: "new" if i in (3, 7, 40) else "old" for i in range(64) if i != 8}
    assert sorted(r.ip for r in store.read("t", "a", [2, 3, 8, 40, 70]).collect()) == [2, 3, 40]
    assert len(store.read("t", "a").inputFiles()) == 2  # emptied folders go

    dice = random.Random(5)
    ips = sorted({i + s for s in (dice.randrange(0, 3000) for _ in range(25)) for i in range(dice.randrange(5, 90))})
    source, none = members(spark, ips, {i for i in ips if (i // 50) % 3 == 0}), spark.createDataFrame([], "ip long")
    weak, strict = (Config(shard_bits=5, chunk_bits=6, h_tiers=("small", "medium", "large", "xlarge"), h_least_valid=n, e_atom_least=9) for n in (4, 60))
    own, full = Store(spark, f"file://{tmp_path}/weak"), Store(spark, f"file://{tmp_path}/strict")
    own.lay_out = lambda run_id, least, most: Store.lay_out(own, run_id, least, most, folders=8)
    repair.store_run(run_pipeline(source, none, weak), own, "a")
    repair.store_run(run_pipeline(source, none, strict), full, "a")
    assert own.fold("a") and not full.fold("a")
    found = repair.scope(own, "a", F.expr("valid_cnt < 60"), strict)
    assert found.shards
    repair.rebuild(own, "a", found, strict)
    assert tables(own, "a") == tables(full, "a")
