"""Queries over ids, shards of members, repairs, whole summaries, tag sets, the anomaly score and the quality gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.operators import profiles, ranks, rules
from blockloom.operators import segments as S
from blockloom.plans import research, tagsets
from blockloom.plans.queries import QUERIES, SQL, query
from blockloom.plans.research import SHARD_BITS
from blockloom.plans.run import Config, Run, run_pipeline
from blockloom.sources.fixture import MEASURES

__all__ = ["QUERIES", "SQL"]


def count(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


_STORED = "floor(100 * mobile / nullif(devices, 0)) / 100"


@query("a7_stored_ratio", f"select count(*) n, count(*) filter (stored = made) equal, round(max(abs(stored - made)), 6) max_difference from (select {_STORED} stored, round(mobile / nullif(devices, 0), 2) made from src where ip * 48271 % 1000 < 250)")
def _(r: Run):
    # the check is of a sample, by a hash of the address; the stored share stands for one that was cut, not rounded
    sample = r.source.where("ip * 48271 % 1000 < 250")
    return profiles.shares_equal(sample, F.floor(100 * S.ratio(F.col("mobile"), F.col("devices"))) / 100, "mobile", "devices")


_SEQ = f"""select *, 'N' || (block >> {SHARD_BITS}) || '_' || block || '_' || (select max(ip) from kept k where k.block = x.block) parent from (select final, block, segment, dense_rank() over (partition by block order by segment) seq, row_number() over (partition by segment order by final) sub, count(*) over (partition by segment) pieces from (select distinct final, block, segment from fm)) x"""


@query("b7_block_ids", f"select final, segment_id, seq_no, case when pieces = 1 then segment_id else segment_id || '_R' || lpad(sub, greatest(length(sub), 2)::int, '0') end final_id from (select final, pieces, cast(sub as varchar) sub, parent || '_' || lpad(cast(seq as varchar), greatest(length(cast(seq as varchar)), 3)::int, '0') segment_id, seq * 1000 + case when pieces = 1 then 0 else sub end seq_no from ({_SEQ}))")
def _(r: Run):
    pieces = r.final_members.groupBy("final").agg(F.min("block").alias("block"), F.min("segment").alias("segment"))
    of = Window.partitionBy("segment")
    p = pieces.withColumns({"seq": F.dense_rank().over(Window.partitionBy("block").orderBy("segment")), "sub": F.row_number().over(of.orderBy("final")), "pieces": F.count(F.lit(1)).over(of)})
    p = p.join(r.pre.select("block", "ip_end"), "block")
    shard = F.shiftright("block", SHARD_BITS)
    p = p.withColumn("segment_id", F.concat_ws("_", F.concat(F.lit("N"), shard), "block", "ip_end", profiles.padded(F.col("seq"), 3)))
    several = F.col("pieces") > 1
    return p.select("final", "segment_id", (F.col("seq") * 1000 + F.when(several, F.col("sub")).otherwise(0)).cast("long").alias("seq_no"), F.when(several, F.concat("segment_id", F.lit("_R"), profiles.padded(F.col("sub"), 2))).otherwise(F.col("segment_id")).alias("final_id"))


@query("b7_run_ids", f"select run, 'E' || (run * 32 >> {SHARD_BITS}) || '_' || run || '_' || atom_end run_id from rn")
def _(r: Run):
    return r.runs[1].select("run", F.concat_ws("_", F.concat(F.lit("E"), F.shiftright(F.col("run") * 32, SHARD_BITS)), "run", "atom_end").alias("run_id"))


@query("c8_member_shards", f"select ip, shard from mem join {research._PLAN} on ip >> 8 between prefix_start and prefix_end")
def _(r: Run):
    plan = research._plan(r).orderBy("shard").collect()  # one row a shard
    bounds = [p.prefix_start * 256 for p in plan] + [(plan[-1].prefix_end + 1) * 256]
    return ranks.assigned(r.members.select("ip"), bounds).where("shard is not null")


@query("g6_library_counters", "select (select count(*) from atm) atoms, (select count(*) from ps) e_atoms, count(*) runs, count(*) filter (short_run) short_runs, quantile_cont(run_len, 0.5) len_p50, quantile_cont(run_len, 0.9) len_p90, quantile_cont(run_len, 0.99) len_p99, max(run_len) len_max, (select count(*) from h) h_members, (select count(*) from hb) h_blocks, (select count(*) from e) e_members, (select count(*) from f) f_members from rn")
def _(r: Run):
    lens = ranks.percentiles(r.runs[1].withColumn("all", F.lit(0)), "all", "run_len", {"len_p50": 0.5, "len_p90": 0.9, "len_p99": 0.99}).drop("all")
    out = r.runs[1].agg(count("runs"), F.count_if("short_run").alias("short_runs"), F.max("run_len").alias("len_max"))
    # each of these has one row
    for one in (lens, r.atoms.agg(count("atoms"), F.count_if("is_e_atom").alias("e_atoms")), r.h.agg(count("h_members")), r.h_blocks.agg(count("h_blocks")), r.e.agg(count("e_members")), r.f.agg(count("f_members"))):
        out = out.crossJoin(F.broadcast(one))
    return out


@query("g7_f_by_difference", "select ip from mem where ip not in (select ip from h) and ip not in (select ip from e) and ip not in (select b.ip from blk b join pre p on p.block = b.block where p.valid_cnt = 0)")
def _(r: Run):
    dropped = r.blocked.join(r.pre.where("not keep_flag").select("block"), "block", "left_semi")
    taken = r.h.select("ip").unionByName(r.e.select("ip")).unionByName(dropped.select("ip"))
    return r.members.select("ip").join(taken, "ip", "left_anti")


@query("g8_overlap_repair", "select 'E' lib, ip from (select ip from e union all select ip from h where ip % 5 = 0) where ip not in (select ip from h) union all select 'R1', ip from (select ip from r1 union all select ip from h where ip % 7 = 0) where ip not in (select ip from h)")
def _(r: Run):
    own = r.h.select("ip")
    # overlaps are planted, as a right run has none
    faulty = {"E": r.e.select("ip").unionByName(own.where("ip % 5 = 0")), "R1": r.r1.select("ip").unionByName(own.where("ip % 7 = 0"))}
    mended = [df.join(own, "ip", "left_anti").select(F.lit(lib).alias("lib"), "ip") for lib, df in faulty.items()]
    return mended[0].unionByName(mended[1])


@query("g9_label_profile", "select l.ip, l.lib, coalesce(f.tier, p.tier) tier, round(coalesce(f.devices_valid / nullif(f.valid_cnt, 0), p.devices_valid / nullif(p.valid_cnt, 0)), 6) density, coalesce(f.score, p.score) score from lab l join blk b on b.ip = l.ip join pre p on p.block = b.block left join fm m on m.ip = l.ip left join fin f on f.final = m.final")
def _(r: Run):
    fields = ["tier", "density", "score"]
    pre = r.pre.select("block", *[F.col(c).alias(f"pre_{c}") for c in fields])
    final = r.final.select("final", *[F.col(c).alias(f"fin_{c}") for c in fields])
    lib = F.when(F.col("fin_tier").isNull(), "D").when(F.col("in_h"), "H").when(F.col("in_e"), "E").otherwise("F")
    e_atoms = r.e.select("atom27").distinct().withColumn("in_e", F.lit(True))
    at = r.blocked.select("ip", "block").join(r.final_members.select("ip", "final", "atom27"), "ip", "left").join(pre, "block").join(final, "final", "left")
    at = at.join(r.h_blocks.select("final", F.lit(True).alias("in_h")), "final", "left").join(e_atoms, "atom27", "left")
    both = lambda c: F.coalesce(f"fin_{c}", f"pre_{c}")
    return at.select("ip", lib.alias("lib"), both("tier").alias("tier"), F.round(both("density"), 6).alias("density"), both("score").alias("score"))


_WIDE = ["country", "operator", *MEASURES]


@query("g10_wide_members", f"select lib, ip, is_valid, {', '.join(f'src.{c}' if c == 'operator' else f'src.{c} {c}' for c in _WIDE)} from (select ip, lib from lab) join src using (ip)")
def _(r: Run):
    return r.labelled.select("lib", "ip", "is_valid", *_WIDE)


_MOST = {m: ("sum", "max", "avg") for m in MEASURES}


def _measures_sql(key: str, table: str) -> str:
    parts = [f"cast(coalesce(sum({m}) filter (is_valid), 0) as bigint) {m}_sum, max({m}) filter (is_valid) {m}_max, round(avg({m}) filter (is_valid), 6) {m}_avg" for m in MEASURES]
    return f"select {key}, count(*) ip_count, count(*) filter (not is_valid) abnormal_count, {', '.join(parts)} from {table} group by 1"


def _measures(df: DataFrame, key: str) -> DataFrame:
    """36 measures over valid rows; abnormal ones are counted."""
    of = lambda m: F.when(F.col("is_valid"), F.col(m))
    parts = [x for m in MEASURES for x in (F.coalesce(F.sum(of(m)), F.lit(0)).alias(f"{m}_sum"), F.max(of(m)).alias(f"{m}_max"), F.round(F.avg(of(m)), 6).alias(f"{m}_avg"))]
    return df.groupBy(key).agg(count("ip_count"), F.count_if(~F.col("is_valid")).alias("abnormal_count"), *parts)


@query("h1_measures", _measures_sql("final", "h"))
def _(r: Run):
    return _measures(r.h, "final")


@query("h5_measures", _measures_sql("run", "e"))
def _(r: Run):
    return _measures(r.e, "run")


_EXT = ", ext as (select 16777216 + o_orderkey ip, coalesce(n, 0) n, coalesce(q, 0) q, coalesce(r, 0) r, coalesce(p, 0) p, coalesce(s, 0) s from orders left join (select l_orderkey k, count(*) n, cast(sum(l_quantity) as bigint) q, count(*) filter (l_returnflag = 'R') r, count(distinct l_partkey) p, count(distinct l_suppkey) s from lineitem group by 1) on k = o_orderkey)"
_FIELD = {"apps": "p", "manufacturers": "s", "daa": "q // 2", "dna": "n", "oaids": "r", "android_ids": "n"}


def _profile_sql(key: str, table: str) -> str:
    sums = ", ".join(f"cast(coalesce(sum({_FIELD.get(m, f't.{m}')}) filter (is_valid), 0) as bigint) {m}" for m in profiles.SUMMED)
    ratios = ", ".join(f"{a} / nullif({b}, 0) {name}" for name, (a, b) in profiles.RATIOS.items())
    return f"(select *, {ratios} from (select t.{key}, count(*) ip_count, {sums} from {table} t join ext using (ip) group by 1) left join (select {key}, operator top_operator from (select {key}, operator, row_number() over (partition by {key} order by count(*) desc, operator) r from {table} where operator is not null and operator <> '' group by 1, 2) where r = 1) using ({key}))"


@query("h5_run_geometry", f"{_EXT} select p.run, ip_start, ip_end, run_len, round(ip_count / (32 * run_len), 6) fill_density, ip_count, {', '.join(f'round({n}, 6) {n}' for n in profiles.RATIOS)} from {_profile_sql('run', 'e')} p join (select run, run * 32 ip_start, atom_end * 32 + 31 ip_end, run_len from rn) using (run)")
def _(r: Run):
    runs = r.runs[1].select("run", "ip_start", "ip_end", "run_len")
    p = profiles.profile(r.e, "run").join(runs, "run")
    return p.select("run", "ip_start", "ip_end", "run_len", F.round(F.col("ip_count") / (32 * F.col("run_len")), 6).alias("fill_density"), "ip_count", *[F.round(n, 6).alias(n) for n in profiles.RATIOS])


_EIGHT = {"mobile_ratio": ("mobile", "devices"), "wifi_ratio": ("wifi", "devices"), "vpn_ratio": ("vpn", "devices"), "wired_ratio": ("wired", "devices"), "report_ratio": ("reports", "devices"), "worktime_ratio": ("worktime", "reports"), "workday_ratio": ("workday", "reports"), "late_night_ratio": ("late_night", "reports")}


@query("h6_address_ratios", "select ip, " + ", ".join(f"coalesce(round({a} / nullif({b}, 0), 4), 0) {n}" for n, (a, b) in _EIGHT.items()) + " from src where ip in (select ip from f)")
def _(r: Run):
    return r.f.select("ip", *[F.coalesce(F.round(S.ratio(F.col(a), F.col(b)), 4), F.lit(0.0)).alias(n) for n, (a, b) in _EIGHT.items()])


#: The given tables' three operators stand for the carriers, and none for the others.
_CARRIERS = {"telecom": "F", "unicom": "O", "cmcc": "P"}
_SETS = {"H": tagsets.h_tags(_CARRIERS), "E": tagsets.e_tags(_CARRIERS), "F": tagsets.f_tags()}


def _rule_sql(rule: dict) -> str:
    for word in ("all", "any"):
        if word in rule:
            return "(" + (" and " if word == "all" else " or ").join(map(_rule_sql, rule[word])) + ")"
    text = lambda v: f"'{v}'" if isinstance(v, str) else repr(v)
    value = f"({', '.join(map(text, rule['value']))})" if rule["op"] == "in" else text(rule["value"])
    return f"coalesce({rule['field']} {rule['op']} {value}, false)"


for _lib, _key, _table in (("H", "final", "h"), ("E", "run", "e"), ("F", "ip", "f")):
    _case = " ".join(f"when {_rule_sql(rule)} then '{name}'" for name, rule in _SETS[_lib])

    @query(f"i7_{_lib.lower()}_tags", f"{_EXT} select {_key}, case {_case} end tag from {_profile_sql(_key, _table if _lib != 'F' else '(select f.*, src.workday, src.late_night, src.abnormal_net from (select ip, operator, is_valid, devices, mobile, wifi, reports from f) f join src using (ip))')}")
    def _(r: Run, lib=_lib, key=_key, table=_table):
        return rules.tag(profiles.profile(getattr(r, table), key), _SETS[lib]).select(key, "tag")


_BAND = lambda bands, beyond: "case " + " ".join(f"when d <= {b} then {v}" for b, v in bands) + f" else {beyond} end"
_POINTS = f"""coalesce(case when d > 1000 then avg_apps_per_device < 0.05 else avg_apps_per_ip < {_BAND(profiles.APP_FLOORS, 'null')} end, false)::int
 + coalesce(avg_apps_per_ip < case when d <= 10 then 5.0 else d * {_BAND(profiles.MODEL_SHARES, 0.3)} end, false)::int + coalesce(avg_manufacturers_per_ip < {_BAND(profiles.MAKER_FLOORS, 'null')}, false)::int
 + coalesce(daa_dna_ratio < case when mobile_device_ratio >= 0.5 then 7 when wifi_device_ratio >= 0.5 then 9 else 5 end, false)::int
 + coalesce(avg_reports_per_ip < d * case when wifi_device_ratio >= 0.5 and not coalesce(mobile_device_ratio >= 0.5, false) then 5 else 3 end, false)::int"""


@query("i9_anomaly", f"{_EXT} select final, anomaly_score, case when anomaly_score is null then 'exempt' when anomaly_score <= 1 then 'normal' when anomaly_score = 2 then 'suspicious' else 'abnormal' end anomaly from (select final, case when not coalesce(ip_count = 1 or (ip_count <= 3 and d <= 5) or coalesce(d, 0) < 5, false) then {_POINTS} end anomaly_score from (select *, avg_devices_per_ip d from {_profile_sql('final', 'fm')}))")
def _(r: Run):
    return profiles.anomaly_score(profiles.profile(r.final_members, "final"), tagsets.CLOUDS).select("final", "anomaly_score", "anomaly")


@query("j2_concentration", "select lib, round(sum(n) filter (r <= 3) / sum(n), 6) top3_share, count(*) operators from (select lib, operator, count(*) n, row_number() over (partition by lib order by count(*) desc, operator) r from lab group by 1, 2) group by 1")
def _(r: Run):
    n = r.labelled.groupBy("lib", "operator").agg(count())  # one row an operator
    first = F.row_number().over(Window.partitionBy("lib").orderBy(F.desc("n"), "operator")) <= 3
    return n.withColumn("first", first).groupBy("lib").agg(F.round(F.sum(F.when(F.col("first"), F.col("n"))) / F.sum("n"), 6).alias("top3_share"), count("operators"))


@query("j6_top_tiers", "select tier, n, round(100 * n / total, 2) percent from (select tier, count(*) n, sum(count(*)) over () total, row_number() over (order by count(*) desc, tier) r from fin group by 1) where r <= 3")
def _(r: Run):
    n = r.final.groupBy("tier").agg(count())  # one row a tier
    return n.withColumn("total", F.sum("n").over(Window.partitionBy())).orderBy(F.desc("n"), "tier").limit(3).select("tier", "n", F.round(100 * F.col("n") / F.col("total"), 2).alias("percent"))


def placements(r: Run) -> DataFrame:
    """The five checks of where addresses are, (name, severity, failures, passed): one aggregation by address over all parts.

    A null address is in no other part, as in a join.
    """
    parts = {"h": r.h, "e": r.e, "f": r.f, "kept": r.kept, "member": r.members}
    every = reduce(DataFrame.unionByName, [df.select("ip", F.lit(i).alias("part")) for i, df in enumerate(parts.values())])
    at = every.groupBy("ip").agg(*[F.count_if(F.col("part") == i).alias(n) for i, n in enumerate(parts)])
    at = at.withColumns({"placed": F.expr("h + e + f"), "known": F.col("ip").isNotNull()})
    failures = {
        "no_overlap_h_e": "if(known and e > 0, h, 0)", "no_overlap_h_f": "if(known and f > 0, h, 0)", "no_overlap_e_f": "if(known and f > 0, e, 0)",
        "conservation": "if(known and placed > 0, 0, kept) + if(known and kept > 0, 0, placed) + if(placed > 1, 1, 0)", "no_ghosts": "if(known and member > 0, 0, placed)",
    }
    one = at.agg(*[F.coalesce(F.sum(F.expr(x)), F.lit(0)).alias(n) for n, x in failures.items()])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit("STOP").alias("severity"), F.col(n).alias("failures")) for n in failures])).alias("x")).select("x.*")
    return rows.withColumn("passed", F.col("failures") == 0)


def checks(r: Run) -> DataFrame:
    """The twelve rows of the quality gate; profiles.enforce() stops on a failed STOP."""
    dropped = r.pre.where("not keep_flag")
    placed = placements(r)
    n = r.config.shards
    ids = research._plan(r).agg(F.countDistinct("shard").alias("ids"), F.max("shard").alias("last")).where((F.col("ids") != n) | (F.col("last") != n - 1))
    missed = profiles.report([
        ("dropped_members_mapped", "STOP", dropped.select("block").join(r.blocked.select("block").distinct().hint("merge"), "block", "left_anti")), ("h_no_invalid", "STOP", r.h_blocks.where("tier = 'invalid'")),
        ("h_valid_min", "STOP", r.h_blocks.where("valid_cnt < 4")), ("f_no_e_atoms", "STOP", r.f.select("atom27").join(r.e.select("atom27").distinct().hint("merge"), "atom27", "left_semi")),
        ("empty_sides", "WARN", r.events.where("l_cnt = 0 or r_cnt = 0")), ("plan_ids", "STOP", ids), ("shards_complete", "STOP", research._missing(r)),
    ])
    return placed.unionByName(missed)


_GATE = {
    "no_overlap_h_e": "select count(*) from h where ip in (select ip from e)", "no_overlap_h_f": "select count(*) from h where ip in (select ip from f)", "no_overlap_e_f": "select count(*) from e where ip in (select ip from f)",
    "conservation": "select (select count(*) from kept where ip not in (select ip from parts)) + (select count(*) from parts where ip not in (select ip from kept)) + (select count(*) from (select ip from parts group by 1 having count(*) > 1))",
    "no_ghosts": "select count(*) from parts where ip not in (select ip from mem)", "dropped_members_mapped": "select count(*) from pre where valid_cnt = 0 and block not in (select block from blk)",
    "h_no_invalid": "select count(*) from hb where tier = 'invalid'", "h_valid_min": "select count(*) from hb where valid_cnt < 4", "f_no_e_atoms": "select count(*) from f where atom27 in (select atom27 from e)",
    "empty_sides": "select count(*) from ev where l_cnt = 0 or r_cnt = 0", "plan_ids": f"select count(*) from (select count(distinct shard) n, max(shard) m from {research._PLAN}) where n <> 8 or m <> 7", "shards_complete": f"select count(*) from {research._MISSING}",
}


@query("k99_gate", ", parts as (select ip from h union all select ip from e union all select ip from f) " + " union all ".join(f"select '{n}' name, '{'WARN' if n == 'empty_sides' else 'STOP'}' severity, ({q}) failures, ({q}) = 0 passed" for n, q in _GATE.items()))
def _(r: Run):
    return checks(r)


_GAP = "select distinct 'E' step, ip >> 12 shard from e where (ip >> 12) % 3 <> 0 union all select distinct 'H', ip >> 12 from h where (ip >> 12) % 4 <> 1"


@query("k10_planted_gaps", f"select step, string_agg(cast(shard as varchar), ',' order by shard) shards from (select step, shard from (values ('E'), ('H')) s(step), (select distinct ip >> 12 shard from mem) where (step, shard) not in (select step, shard from ({_GAP}))) group by 1")
def _(r: Run):
    """Shards that lack rows of a step, where rows of some shards are taken out first."""
    shard = F.shiftright("ip", SHARD_BITS).alias("shard")
    made = r.e.select(F.lit("E").alias("step"), shard).where("shard % 3 <> 0").unionByName(r.h.select(F.lit("H").alias("step"), shard).where("shard % 4 <> 1")).distinct()
    every = r.members.select(shard).distinct().select("shard", F.explode(F.array(F.lit("E"), F.lit("H"))).alias("step"))
    gone = every.join(made, ["step", "shard"], "left_anti")
    return gone.groupBy("step").agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("shard")), lambda x: x.cast("string"))).alias("shards"))  # one entry a shard


_OWN = "select 50331648 + o_custkey * 3 + n % 2 ip, count(*) n from (select o_custkey, o_orderkey // 32 n from orders) group by 1"


@query("a1_own_tables", f", own as ({_OWN}), isl as (select *, min(ip) over (partition by g) block from (select *, ip - row_number() over (order by ip) g from own)) select block, min(ip) ip_start, max(ip) ip_end, count(*) member_cnt, count(*) filter (ip % 7 <> 0) valid_cnt, cast(sum(n) as bigint) reports_total from isl group by 1")
def _(r: Run):
    """Pre-profiles of a run over another member table, with its own configuration."""
    orders = r.spark.read.parquet(f"{r.sf_dir}/orders.parquet")
    n = orders.groupBy(F.expr("50331648 + o_custkey * 3 + (o_orderkey div 32) % 2").cast("long").alias("ip")).agg(count())
    zero = [F.lit(0).cast("long").alias(m) for m in MEASURES if m != "reports"]
    own = n.select("ip", F.lit("XX").alias("country"), F.lit("one").alias("operator"), F.col("n").alias("reports"), *zero)
    other = run_pipeline(own, n.where("ip % 7 = 0").select("ip"), Config(countries=("XX",), chunk_bits=6))
    return other.pre.select("block", "ip_start", "ip_end", "member_cnt", "valid_cnt", "reports_total")
