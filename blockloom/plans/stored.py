"""Queries over stored runs, run states, rule packs, field configurations and adaptive plans."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from blockloom.operators import fields, packs, plan, ranks, statistics
from blockloom.operators import segments as S
from blockloom.plans import repair, research
from blockloom.plans.details import QUERIES, SQL
from blockloom.plans.queries import CTE, query, run_of
from blockloom.plans.run import Config, Run
from blockloom.sources.stage import shared_dir
from blockloom.sources.store import Store

__all__ = ["QUERIES", "SQL"]

#: A run is stored with the default least number of valid members of an H block, and repaired with this one.
STRICT = 63
_STRICT_CTE = CTE.replace("valid_cnt >= 4 and member_cnt >= 4", f"valid_cnt >= {STRICT} and member_cnt >= 4")
_FAILING = f"valid_cnt < {STRICT}"


def _store(r: Run) -> Store:
    return Store(r.spark, f"{shared_dir(r.spark)}/store-{uuid.uuid4().hex}")


_BAD = f"bad as (select * from h where final in (select final from hb where {_FAILING})), gain as (select atom27, count(*) filter (is_valid) gain from bad group by 1)"
_CHAINS = f"""{_BAD}, linked as (select atom27 from ps union select atom27 from gain), chains as (select atom27, sum(fresh) over (order by atom27) chain from (select atom27, case when atom27 - lag(atom27) over (order by atom27) <= 2 then 0 else 1 end fresh from linked)),
dirty as (select atom27 from chains where chain in (select chain from chains where atom27 in (select atom27 from gain)))"""


def stored_and_repaired(r: Run) -> tuple[Store, repair.Scope]:
    """A stored run whose H blocks below STRICT valid members are then taken back."""
    store, config = _store(r), Config(h_least_valid=STRICT)
    repair.store_run(r, store, "one")
    found = repair.scope(store, "one", F.expr(_FAILING), config)
    repair.rebuild(store, "one", found, config)
    return store, found


@query("k14_whole_scope", f", {_CHAINS} select 'block' kind, final id from hb where {_FAILING} union all select 'member', ip from bad union all select 'atom', atom27 from dirty union all select distinct 'run', run from ps where atom27 in (select atom27 from dirty) union all select distinct 'shard', s from (select atom27 >> 7 s from dirty union select ip_start >> 12 from hb where {_FAILING})")
def _(r: Run):
    """What taking back the H blocks of few valid members reaches: blocks, members, atoms, runs and shards."""
    store = _store(r)
    repair.store_run(r, store, "one")
    found = repair.scope(store, "one", F.expr(_FAILING), r.config)
    part = lambda df, kind, c: df.select(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id"))
    out = part(found.blocks, "block", "final").unionByName(part(found.members, "member", "ip")).unionByName(part(found.atoms, "atom", "atom27")).unionByName(part(found.runs, "run", "run"))
    return out.unionByName(part(r.spark.createDataFrame([(s,) for s in found.shards], "s long"), "shard", "s"))


def _repaired(name: str, sql: str):
    """A query over the repaired store; its SQL computes everything anew under the stricter rule."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(stored_and_repaired(run_of(spark, sf_dir))[0])
        SQL[name] = _STRICT_CTE + sql
        return f

    return add


@_repaired("k15_rebuilt_members", "select 'H' lib, ip, final id from h union all select 'E', ip, run from e union all select 'F', ip, atom27 from f union all select 'R', ip, atom27 from r1")
def _(store: Store):
    part = lambda t, lib, c: store.read(t, "one").select(F.lit(lib).alias("lib"), "ip", F.col(c).alias("id"))
    return part("h", "H", "final").unionByName(part("e", "E", "run")).unionByName(part("f", "F", "atom27")).unionByName(part("r1", "R", "atom27"))


_SUMMED = "cast(coalesce(sum(devices) filter (is_valid), 0) as bigint) devices, cast(coalesce(sum(reports) filter (is_valid), 0) as bigint) reports"


@_repaired("k15_rebuilt_summaries", f"select 'H' lib, final id, count(*) ip_count, {_SUMMED} from h group by 2 union all select 'E', run, count(*), {_SUMMED} from e group by 2 union all select 'F', ip, 1, devices, reports from f")
def _(store: Store):
    part = lambda t, lib, c: store.read(t, "one").select(F.lit(lib).alias("lib"), F.col(c).alias("id"), (F.col("ip_count") if t != "f_summary" else F.lit(1)).cast("long").alias("ip_count"), "devices", "reports")
    return part("h_summary", "H", "final").unionByName(part("e_summary", "E", "run")).unionByName(part("f_summary", "F", "ip"))


@_repaired("k15_rebuilt_runs", "select run, atom_end, run_len, short_run, (select cast(sum(valid_cnt) as bigint) from ps where ps.run = rn.run) valid_cnt from rn")
def _(store: Store):
    valid = store.read("passing", "one").groupBy("run").agg(F.sum("valid_cnt").alias("valid_cnt"))
    return store.read("runs", "one").select("run", "atom_end", "run_len", "short_run").join(valid, "run")


# --- states of runs

_DAY = datetime.datetime(2024, 1, 1)


def registered(r: Run) -> Store:
    """Four runs: whole and passed; whole with a failed check; part of one summary incomplete and one missing; only entered."""
    store, bits = _store(r), r.config.shard_bits
    h, e, f = repair.h_summary(r.h, r.h_blocks), repair.e_summary(r.e, r.runs[1]), repair.f_summary(r.f)
    row = lambda *x: r.spark.createDataFrame(list(x), "name string, severity string, failures long, passed boolean")
    for i, run_id in enumerate(("whole", "failed", "part", "empty")):
        store.register(run_id, _DAY + datetime.timedelta(days=i))
    repair.lay_out(r, store, "whole", "failed", "part")
    for run_id in ("whole", "failed"):
        for table, df in (("h_summary", h), ("e_summary", e), ("f_summary", f)):
            store.write(table, df, run_id, repair.shard_of(table, bits))
    store.write("h_summary", h.withColumn("avg_apps_per_ip", F.when(F.col("final") % 2 == 0, F.col("avg_apps_per_ip"))), "part", repair.shard_of("h_summary", bits))
    store.write("f_summary", f, "part", repair.shard_of("f_summary", bits))
    store.write("checks", row(("overlap", "STOP", 0, True), ("sides", "WARN", 0, True)), "whole", F.lit(0))
    store.write("checks", row(("overlap", "STOP", 3, False), ("sides", "WARN", 0, True)), "failed", F.lit(0))
    return store


_N = "(select count(distinct final) from h) h, (select count(distinct run) from e) e, (select count(*) from f) f, (select count(distinct final) from h where final % 2 = 0) even, (select count(distinct final) from h) - (select count(distinct final) from h where final % 2 = 0) odd"
_H_STATE = "case when h = 0 then 'missing' when even < h then 'partial' else 'ready' end"
_S = lambda c: f"case when {c} = 0 then 'missing' else 'ready' end"
_STATES = f"""select 'whole' run_id, 'h' lib, h total, h ready, {_S('h')} state from n union all select 'whole', 'e', e, e, {_S('e')} from n union all select 'whole', 'f', f, f, {_S('f')} from n
union all select 'failed', 'h', h, h, {_S('h')} from n union all select 'failed', 'e', e, e, {_S('e')} from n union all select 'failed', 'f', f, f, {_S('f')} from n
union all select 'part', 'h', h, even, {_H_STATE} from n union all select 'part', 'e', 0, 0, 'missing' from n union all select 'part', 'f', f, f, {_S('f')} from n
union all select 'empty', lib, 0, 0, 'missing' from (values ('h'), ('e'), ('f')) v(lib)"""
_PLACE = "case run_id when 'whole' then 0 when 'failed' then 1 when 'part' then 2 else 3 end"


@query("a9_resolved_runs", "select 'latest' asked, 'empty' run_id union all select 'whole', 'whole'")
def _(r: Run):
    store = _store(r)
    for i, run_id in enumerate(("whole", "failed", "part", "empty")):
        store.register(run_id, _DAY + datetime.timedelta(days=i))
    return r.spark.createDataFrame([(x, store.resolve(x)) for x in ("latest", "whole")], "asked string, run_id string")


@query("a10_summary_states", f", n as (select {_N}), s as ({_STATES}) select run_id, lib, total, ready, state, case when state <> 'ready' then (select max_by(run_id, {_PLACE}) from s b where b.lib = s.lib and b.state = 'ready') end fallback from s")
def _(r: Run):
    return registered(r).summary_states().drop("created_at")


@query("j28_runs_with_flags", f", n as (select {_N}), s as ({_STATES}), w as (select run_id, max(total) filter (lib = 'h') h_rows, max(total) filter (lib = 'e') e_rows, max(total) filter (lib = 'f') f_rows, bool_or(lib = 'h' and state = 'ready') h_ready, bool_or(lib = 'e' and state = 'ready') e_ready, bool_or(lib = 'f' and state = 'ready') f_ready from s group by 1) select run_id, h_rows, e_rows, f_rows, h_ready, e_ready, f_ready, case when run_id in ('whole', 'failed') then 2 else 0 end checks, case run_id when 'whole' then 2 when 'failed' then 1 else 0 end checks_passed, run_id = 'whole' all_passed, h_ready and e_ready and f_ready bundle_ready, h_ready and e_ready and f_ready and run_id = 'whole' preferred from w")
def _(r: Run):
    return registered(r).run_list().drop("created_at")


# --- rule packs and field configurations

_PACKS = [
    (1, "any", "H", None, '[{"metric": "valid_cnt", "op": ">=", "val": 4}]'), (2, "dense", "H", 1, '[{"metric": "density", "op": ">", "val": 20}]'),
    (3, "dense_mobile", "H", 2, '[{"metric": "mobile_valid", "op": ">", "val": 10}, {"metric": "tier", "op": "!=", "val": "xlarge"}]'), (4, "small", "H", None, '[{"metric": "tier", "op": "in", "val": ["small", "micro"]}]'), (5, "short", "E", None, '[{"metric": "short_run", "op": "=", "val": true}]'),
]


@query("i8_inherited_packs", "select pack, final from fin, (values ('any'), ('dense'), ('dense_mobile'), ('small')) p(pack) where case pack when 'small' then tier in ('small', 'micro') else valid_cnt >= 4 and (pack = 'any' or devices_valid > 20 * valid_cnt) and (pack <> 'dense_mobile' or (mobile_valid > 10 and tier <> 'xlarge')) end")
def _(r: Run):
    return packs.matches(r.final, r.spark.createDataFrame(_PACKS, packs.SCHEMA), "H", "final")


_CONFIG = """{"library": "h", "fields": [{"name": "country", "keep": false}, {"name": "atom27", "keep": false}, {"name": "ip", "keep": true}, {"name": "wifi", "keep": false}],
"computed_columns": [{"name": "activity", "fieldA": "reports", "op": "+", "fieldB": "devices"}, {"name": "rest", "fieldA": "activity", "op": "-", "fieldB": "wifi"},
{"name": "per_device", "fieldA": "reports", "op": "/", "fieldB": "devices"}, {"name": "twice", "fieldA": "mobile", "op": "*", "fieldB": 2}]}"""


@query("b13_field_config", "select ip, operator, is_valid, bucket64, reports, devices, mobile, worktime, reports + devices activity, reports + devices - wifi rest, round(reports / nullif(devices, 0), 6) per_device, mobile * 2 twice from mem")
def _(r: Run):
    kept = r.members.select("ip", "country", "operator", "is_valid", "atom27", "bucket64", "reports", "devices", "mobile", "wifi", "worktime")
    return fields.project(kept, _CONFIG).withColumn("per_device", F.round("per_device", 6))


# --- adaptive plans

_BOUND = "greatest(1, cast(floor((select count(*) from mem) / 8 * 0.05) as bigint))"
_LEVEL = ", ".join(f"count(*) over (partition by ip >> {b}) n{b}" for b in (16, 12, 8, 4))
_BINS = f"bins as (select start, bits, count(*) n from (select ip, bits, (ip >> bits) << bits start from (select *, case when n16 <= bound then 16 when n12 <= bound then 12 when n8 <= bound then 8 else 4 end bits from (select ip, {_LEVEL}, {_BOUND} bound from mem))) group by 1, 2)"
_ADAPTED = f"{_BINS}, cut as (select start, n, cast((sum(n) over (order by start) - 1) * 8 // (select count(*) from mem) as bigint) shard from bins), made as (select shard, min(start) ip_start, cast(sum(n) as bigint) n from cut group by 1), plan as (select shard, ip_start, coalesce(lead(ip_start) over (order by shard), (select max(ip) + 1 from mem)) ip_end, n from made)"


@query("c2_adaptive_bins", f", {_BINS} select * from bins")
def _(r: Run):
    n = r.members.count()
    return plan.bins(r.members, max(1, int(n / 8 * 0.05)))


@query("c3_half_open_plan", f", {_ADAPTED} select * from plan")
def _(r: Run):
    return plan.plan(r.members, r.config.shards)


@query("c3_dealt_members", f", {_ADAPTED} select shard, count(*) n, min(ip) ip_min, max(ip) ip_max from mem join plan on ip >= ip_start and ip < ip_end group by 1")
def _(r: Run):
    """Members dealt to partitions by the plan: a row a partition, so the partitioner's work is what is compared."""
    ends = plan.bounds(plan.plan(r.members, r.config.shards))
    dealt = plan.dealt(r.members.select("ip"), ends).withColumn("part", F.spark_partition_id().cast("long"))
    return dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("ip").alias("ip_min"), F.max("ip").alias("ip_max"), F.max("shard").alias("s")).where("s = part").select(F.col("part").alias("shard"), "n", "ip_min", "ip_max")


@query("c7_adaptive_checks", f", {_ADAPTED} select count(*) = 8 all_shards, min(n) > 0 none_empty, bool_and(following is null or following = ip_end) joined, sum(n) >= 8 enough_rows from (select *, lead(ip_start) over (order by shard) following from plan)")
def _(r: Run):
    return plan.checks(plan.plan(r.members, r.config.shards), r.config.shards)


# --- statistics in long form, and first rows of groups

_WANTED = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
_SHARE = lambda a, b: (F.col(f"{a}_valid"), F.col(f"{b}_valid"))
_RATIOS = {"mobile_share": ("mobile", "devices"), "worktime_share": ("worktime", "reports"), "holiday_share": ("weekend", "reports")}


def _metrics(final: bool) -> dict:
    """Fixed: what is measured of blocks before and after splitting; shares of the final ones only."""
    valid = F.col("valid_cnt") > 0
    out = {"members": F.col("member_cnt"), "devices": F.when(valid, F.col("devices_valid")), "reports": F.when(valid, F.col("reports_valid")), "density": F.col("density"), "report_density": F.col("report_density")}
    return out | ({n: S.ratio(*_SHARE(a, b)) for n, (a, b) in _RATIOS.items()} if final else {})


def _long_sql(table: str, final: bool) -> str:
    each = {"members": "member_cnt", "devices": "case when valid_cnt > 0 then devices_valid end", "reports": "case when valid_cnt > 0 then reports_valid end", "density": "devices_valid / nullif(valid_cnt, 0)", "report_density": "reports_valid / nullif(valid_cnt, 0)"}
    each |= {n: f"{a}_valid / nullif({b}_valid, 0)" for n, (a, b) in _RATIOS.items()} if final else {}
    long = " union all ".join(f"select '{m}' metric, ip_start >> 12 shard, cast({x} as double) v from {table}" for m, x in each.items())
    stats = {"count": "count(v)", "mean": "avg(v)", "least": "min(v)", "most": "max(v)", **{n: f"quantile_cont(v, {q})" for n, q in _WANTED.items()}}
    return f"select metric, coalesce(shard, -1) shard, unnest([{', '.join(f'{chr(39)}{s}{chr(39)}' for s in stats)}]) stat, unnest([{', '.join(f'round(cast({x} as double), 6)' for x in stats.values())}]) as value from ({long}) where v is not null group by grouping sets ((metric, shard), (metric))"


@query("e9_long_stats", _long_sql("pre", False))
def _(r: Run):
    return statistics.summed_up(statistics.counted(r.pre, _metrics(False), F.shiftright("ip_start", r.config.shard_bits)), _WANTED)


@query("e11_long_stats", _long_sql("fin", True))
def _(r: Run):
    """Counted in two parts, before and after the middle of the address space, and merged."""
    shard, low = F.shiftright("ip_start", r.config.shard_bits), F.col("ip_start") % 2 == 0
    parts = [statistics.counted(r.final.where(x), _metrics(True), shard) for x in (low, ~low)]
    return statistics.summed_up(statistics.merged(*parts), _WANTED)


@query("j9_longest_thin_runs", "select run, run_len, mean_valid from (select run, count(*) run_len, round(avg(valid_cnt), 6) mean_valid, row_number() over (order by count(*) desc, run) place from ps group by 1 having count(*) >= 3 and avg(valid_cnt) < 20) where place <= 20")
def _(r: Run):
    runs = r.runs[0].groupBy("run").agg(F.count(F.lit(1)).alias("run_len"), F.avg("valid_cnt").alias("m")).where("run_len >= 3 and m < 20")
    return runs.orderBy(F.desc("run_len"), "run").limit(20).select("run", "run_len", F.round("m", 6).alias("mean_valid"))


@query("j10_nearest_misses", "select shard, place, ip, valid_cnt from (select ip >> 12 shard, ip, valid_cnt, row_number() over (partition by ip >> 12 order by valid_cnt desc, ip) place from f join atm using (atom27) where valid_cnt >= 5) where place <= 10")
def _(r: Run):
    near = r.f.join(r.atoms.where("valid_cnt >= 5").select("atom27", "valid_cnt"), "atom27").select(F.shiftright("ip", r.config.shard_bits).alias("shard"), "ip", "valid_cnt")
    return ranks.top(near, ["shard"], [F.desc("valid_cnt"), F.col("ip")], 10).select("shard", F.col("place").cast("long").alias("place"), "ip", "valid_cnt")


@query("j6_top_operators", "select lib, operator, n, percent from (select lib, operator, count(*) n, round(100 * count(*) / sum(count(*)) over (partition by lib), 2) percent, row_number() over (partition by lib order by count(*) desc, operator) place from lab where operator is not null and operator <> '' group by 1, 2) where place <= 2")
def _(r: Run):
    n = r.labelled.where("operator is not null and operator <> ''").groupBy("lib", "operator").agg(F.count(F.lit(1)).alias("n"))
    every = n.groupBy("lib").agg(F.sum("n").alias("every"))
    return ranks.top(n, ["lib"], [F.desc("n"), F.col("operator")], 2).join(every, "lib").select("lib", "operator", "n", F.round(100 * F.col("n") / F.col("every"), 2).alias("percent"))


_ZONED = """select 'H' lib, ip, case when score between 18 and 22 then 'boundary' when parts > 1 then 'split' else 'other' end zone from h join (select final, score, block from fin) using (final) join (select block p, count(*) parts from fin group by 1) on p = h.block
union all select 'E', ip, case when valid_cnt <= 8 then 'boundary' when parts > 1 then 'split' else 'other' end from e join atm using (atom27) join (select block p, count(*) parts from fin group by 1) on p = e.block
union all select 'F', ip, case when valid_cnt between 5 and 6 then 'boundary' when parts > 1 then 'split' else 'other' end from f join atm using (atom27) join (select block p, count(*) parts from fin group by 1) on p = f.block"""


@query("j19_library_zones", f"select lib, zone, ip from (select *, row_number() over (partition by lib, zone order by {research._PICK.format(k='ip')}) place from ({_ZONED})) where place <= 20")
def _(r: Run):
    """Twenty addresses of each library and zone, in the order of a hash: near a threshold, of a block that was split, others."""
    parts = r.final.groupBy("block").agg(F.count(F.lit(1)).alias("parts"))
    zone = lambda near: F.when(near, "boundary").when(F.col("parts") > 1, "split").otherwise("other").alias("zone")
    atoms = r.atoms.select("atom27", "valid_cnt")
    h = r.h.join(r.final.select("final", "score"), "final").join(parts, "block").select(F.lit("H").alias("lib"), "ip", zone(F.col("score").between(18, 22)))
    e = r.e.join(atoms, "atom27").join(parts, "block").select(F.lit("E").alias("lib"), "ip", zone(F.col("valid_cnt") <= 8))
    f = r.f.join(atoms, "atom27").join(parts, "block").select(F.lit("F").alias("lib"), "ip", zone(F.col("valid_cnt").between(5, 6)))
    return ranks.top(h.unionByName(e).unionByName(f), ["lib", "zone"], [research._pick("ip")], 20).select("lib", "zone", "ip")
