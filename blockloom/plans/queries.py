"""One query per operator over the run's stages, with the same result in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockloom.operators import ranks
from blockloom.operators import segments as S
from blockloom.plans.run import Run
from blockloom.sources.fixture import MEASURES

_RUNS: dict[tuple[str, str], Run] = {}


def run_of(spark: SparkSession, sf_dir: str) -> Run:
    """The run of this application over sf_dir: its stage tables are written once and shared by queries."""
    return _RUNS.setdefault((spark.sparkContext.applicationId, sf_dir), Run(spark, sf_dir))


_SUMS = ", ".join(f"cast(coalesce(sum({m}), 0) as bigint) {m}_total, cast(coalesce(sum({m}) filter (is_valid), 0) as bigint) {m}_valid" for m in MEASURES)
_SCORED = """
  select *, case when valid_cnt = 0 then 'invalid' when score >= 40 then 'xlarge' when score >= 30 then 'large' when score >= 20 then 'medium' when score >= 10 then 'small' else 'micro' end tier
  from (select *, wa + wd score from (select *,
    case when valid_cnt = 0 then null when valid_cnt <= 16 then 1 when valid_cnt <= 48 then 2 when valid_cnt <= 128 then 4 when valid_cnt <= 512 then 8 else 16 end wa,
    case when valid_cnt = 0 then null when 2*devices_valid <= 7*valid_cnt then 1 when 2*devices_valid <= 13*valid_cnt then 2 when devices_valid <= 30*valid_cnt then 4 when devices_valid <= 200*valid_cnt then 16 else 32 end wd
    from {sums}))"""
_STATS = "avg(reports) filter (rn <= 5) mr, stddev_samp(reports) filter (rn <= 5) sr, avg(devices) filter (rn <= 5) md, stddev_samp(devices) filter (rn <= 5) sd, count(*) filter (rn <= 5) cnt, coalesce(sum(reports) filter (rn <= 5), 0) reports, coalesce(sum(mobile) filter (rn <= 5), 0) mobile, sum(devices) filter (rn <= 5) devices, case when count(distinct case when rn <= 5 then operator end) = 1 then max(case when rn <= 5 then operator end) end op"
CTE = f"""with
li as (select l_orderkey k, count(*) n, cast(sum(l_quantity) as bigint) q, count(*) filter (l_returnflag = 'R') r, count(*) filter (l_returnflag = 'A') a from lineitem group by 1),
o as (select o_orderkey k, o_custkey cust, o_orderstatus operator, coalesce(n, 0) n, coalesce(q, 0) q, coalesce(r, 0) r, coalesce(a, 0) a, (o_orderkey // 512) % 3 zone, (o_orderkey // 1536) % 4 c, o_orderkey % 1536 z from orders left join li on o_orderkey = k),
src as (select 16777216 + k ip, operator, case when zone = 0 or (zone = 1 and cust % 5 <> 0) or (zone = 2 and cust % 6 = 0) then 'CN' else 'OTHER' end country,
  q * (case when c = 3 and z between 64 and 127 then 10 else 1 end) reports, case when zone = 0 and z < 400 then q * (case when c in (1, 2) then 3 else 1 end) else n end devices,
  r mobile, a wifi, 0 vpn, 0 wired, 0 abnormal_net, 0 empty_net, q // 3 worktime, q - q // 4 workday, q // 4 weekend, q // 8 late_night, not (k % 41 = 0 or (c <> 2 and z between 128 and 319)) is_valid from o),
mem as (select *, ip // 32 atom27, ip // 64 bucket64 from src where country = 'CN'),
blk as (select *, min(ip) over (partition by g) block from (select *, ip - row_number() over (order by ip) g from mem)),
presum as (select block, min(ip) ip_start, max(ip) ip_end, count(*) member_cnt, count(*) filter (is_valid) valid_cnt, {_SUMS} from blk group by block),
pre as ({_SCORED.format(sums="presum")}),
kept as (select b.* from blk b join pre p on p.block = b.block where p.valid_cnt > 0),
cand as (select * from pre where valid_cnt > 0 and ip_start // 64 <> ip_end // 64),
v as (select b.* from blk b join cand using (block)),
edge as (select distinct x.block, x.bucket64 from v x join v y on y.block = x.block and y.bucket64 = x.bucket64 + 1),
ls as (select block, bucket64, {_STATS} from (select *, row_number() over (partition by block, bucket64 order by ip desc) rn from v where is_valid) group by 1, 2),
rs as (select block, bucket64, {_STATS} from (select *, row_number() over (partition by block, bucket64 order by ip) rn from v where is_valid) group by 1, 2),
met as (select e.block, e.bucket64, (e.bucket64 + 1) * 64 cut_ip, coalesce(l.cnt, 0) l_cnt, coalesce(r.cnt, 0) r_cnt, coalesce(l.reports, 0) l_reports, coalesce(r.reports, 0) r_reports, coalesce(l.mobile, 0) l_mobile, coalesce(r.mobile, 0) r_mobile, l.op l_op, r.op r_op,
  case when l.cnt > 0 and r.cnt > 0 then greatest(r.mr / nullif(l.mr, 0), l.mr / nullif(r.mr, 0)) end ratio_report, l.sr / nullif(l.mr, 0) cv_l, r.sr / nullif(r.mr, 0) cv_r,
  case when l.cnt > 0 and r.cnt > 0 then abs(r.mobile / nullif(r.devices, 0) - l.mobile / nullif(l.devices, 0)) end mobile_diff, case when l.cnt > 0 and r.cnt > 0 then greatest(r.mobile / nullif(l.mobile, 0), l.mobile / nullif(r.mobile, 0)) end mobile_ratio,
  case when l.cnt > 0 and r.cnt > 0 then greatest(r.md / nullif(l.md, 0), l.md / nullif(r.md, 0)) end device_ratio, l.sd / nullif(l.md, 0) dv_l, r.sd / nullif(r.md, 0) dv_r
  from edge e left join ls l on l.block = e.block and l.bucket64 = e.bucket64 left join rs r on r.block = e.block and r.bucket64 = e.bucket64 + 1),
flags as (select *, coalesce(ratio_report > 4 and cv_l < 1.1 and cv_r < 1.1, false) trigger_report, coalesce(mobile_diff > 0.5 or mobile_ratio > 4, false) trigger_mobile, coalesce(l_op <> r_op, false) trigger_operator,
  coalesce(device_ratio > 10 and coalesce(dv_l, 0) < 1.5 and coalesce(dv_r, 0) < 1.5, false) trigger_density, sum(case when r_cnt > 0 then 1 else 0 end) over (partition by block order by bucket64) grp from met),
zone as (select block, min(bucket64) lo, max(bucket64) hi from flags where r_cnt = 0 group by block, grp having count(*) > 2),
ev as (select f.*, exists (select 1 from zone z where z.block = f.block and (z.lo = f.bucket64 or z.hi + 1 = f.bucket64)) trigger_void from flags f),
cuts as (select block, cut_ip from ev where trigger_report or trigger_mobile or trigger_operator or trigger_density or trigger_void),
seg as (select k.*, max(case when k.ip = k.block or c.cut_ip is not null then k.ip end) over (partition by k.block order by k.ip) segment from kept k left join cuts c on c.block = k.block and c.cut_ip = k.ip),
win as (select segment, (ip - segment) // 16 win, avg(devices) mean from seg where segment in (select segment from seg group by 1 having max(ip) - segment + 1 >= 64) group by 1, 2),
jump as (select b.segment, b.segment + b.win * 16 cut_ip from win a join win b on b.segment = a.segment and b.win = a.win + 1
  where greatest(a.mean / nullif(b.mean, 0), b.mean / nullif(a.mean, 0)) > 10 and a.segment in (select segment from win group by 1 having max(mean) / nullif(min(mean), 0) > 10)),
fm as (select s.*, max(case when s.ip = s.segment or j.cut_ip is not null then s.ip end) over (partition by s.segment order by s.ip) final from seg s left join jump j on j.segment = s.segment and j.cut_ip = s.ip),
finsum as (select final, min(block) block, min(ip) ip_start, max(ip) ip_end, count(*) member_cnt, count(*) filter (is_valid) valid_cnt, {_SUMS} from fm group by final),
fin as ({_SCORED.format(sums="finsum")}),
hb as (select * from fin where tier in ('medium', 'large', 'xlarge') and valid_cnt >= 4 and member_cnt >= 4),
h as (select * from fm where final in (select final from hb)),
r1 as (select * from fm where final not in (select final from hb)),
atm as (select atom27, count(*) filter (is_valid) valid_cnt from r1 group by 1),
ps as (select atom27, valid_cnt, min(atom27) over (partition by g) run from (select *, atom27 - row_number() over (order by atom27) g from atm where valid_cnt >= 7)),
rn as (select run, max(atom27) atom_end, count(*) run_len, count(*) < 3 short_run from ps group by 1),
e as (select r1.*, ps.run from r1 join ps using (atom27) join rn using (run) where not short_run),
f as (select * from r1 where atom27 not in (select atom27 from e)),
lab as (select 'H' lib, ip, operator, is_valid, reports, devices, mobile from h union all select 'E', ip, operator, is_valid, reports, devices, mobile from e union all select 'F', ip, operator, is_valid, reports, devices, mobile from f
  union all select 'D', b.ip, b.operator, b.is_valid, b.reports, b.devices, b.mobile from blk b join pre p on p.block = b.block where p.valid_cnt = 0)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f: Callable[[Run], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(run_of(spark, sf_dir))
        SQL[name] = CTE + sql
        return f

    return add


_FLAT = ", ".join(f"cast({m}_{s} as bigint) {m}_{s}" for m in MEASURES for s in ("total", "valid"))
_PROFILE = f"ip_start, ip_end, member_cnt, valid_cnt, round(devices_valid / nullif(valid_cnt, 0), 6) density, round(reports_valid / nullif(valid_cnt, 0), 6) report_density, wa, wd, score, tier, {_FLAT}"


def _profile(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "ip_start", "ip_end", "member_cnt", "valid_cnt", F.round("density", 6).alias("density"), F.round("report_density", 6).alias("report_density"), "wa", "wd", "score", "tier", *[f"{m}_{s}" for m in MEASURES for s in ("total", "valid")])


@query("b2_members", "select ip, operator, is_valid, atom27, bucket64, reports, devices, mobile from mem")
def _(r: Run):
    return r.members.select("ip", "operator", "is_valid", "atom27", "bucket64", "reports", "devices", "mobile")


@query("a2_abnormal_keys", "select ip from src where not is_valid")
def _(r: Run):
    return r.abnormal.where("ip is not null").dropDuplicates(["ip"])


@query("a6_source_sanity", "select country, count(*) n, count(distinct ip) keys, count(*) filter (operator is null) null_operators, count(distinct operator) operators from src group by 1")
def _(r: Run):
    return r.source.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ip").alias("keys"), F.count_if(F.col("operator").isNull()).alias("null_operators"), F.countDistinct("operator").alias("operators"))


@query("b4_dotted_quad", "select ip, concat_ws('.', (ip >> 24) & 255, (ip >> 16) & 255, (ip >> 8) & 255, ip & 255) address, ip as again from mem")
def _(r: Run):
    return r.members.select("ip", S.dotted(F.col("ip")).alias("address")).withColumn("again", S.from_dotted(F.col("address")))


@query("c1_prefix_histogram", "select ip >> 8 prefix, count(*) n from mem group by 1")
def _(r: Run):
    return r.members.groupBy(F.shiftright("ip", 8).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@query("c3_shard_plan", "select shard, min(prefix) prefix_start, max(prefix) prefix_end, cast(sum(n) as bigint) n from (select prefix, n, cast((sum(n) over (order by prefix) - 1) * 8 // sum(n) over () as bigint) shard from (select ip >> 8 prefix, count(*) n from mem group by 1)) group by 1")
def shard_plan(r: Run):
    bins = r.members.groupBy(F.shiftright("ip", 8).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))  # one row a prefix
    at = ranks.running(bins, "prefix", "n", "cum", "all")
    return at.groupBy(F.expr(f"((cum - 1) * {r.config.shards}) div all").alias("shard")).agg(F.min("prefix").alias("prefix_start"), F.max("prefix").alias("prefix_end"), F.sum("n").alias("n"))


@query("d1_natural_blocks", "select block, ip_start, ip_end, member_cnt from presum")
def _(r: Run):
    return r.pre.select("block", "ip_start", "ip_end", "member_cnt")


@query("d2_member_block", "select ip, block from blk")
def _(r: Run):
    return r.blocked.select("ip", "block")


@query("d3_block_stats", "select count(*) blocks, count(*) filter (member_cnt >= 4) blocks4, round(avg(member_cnt), 6) mean, quantile_cont(member_cnt, 0.5) p50, quantile_cont(member_cnt, 0.9) p90, quantile_cont(member_cnt, 0.99) p99, max(member_cnt) largest from presum")
def _(r: Run):
    one = r.pre.withColumn("every", F.lit(0))
    q = ranks.percentiles(one, "every", "member_cnt", {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    out = one.groupBy("every").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("member_cnt") >= 4).alias("blocks4"), F.round(F.avg("member_cnt"), 6).alias("mean"), F.max("member_cnt").alias("largest"))
    return out.join(q, "every").drop("every")


@query("d4_atoms", "select atom27, valid_cnt, valid_cnt / 32.0 density, valid_cnt >= 7 is_e_atom from atm")
def _(r: Run):
    return r.atoms.select("atom27", "valid_cnt", F.col("density").cast("double").alias("density"), "is_e_atom")


@query("d5_runs", "select run, atom_end, run_len, short_run, run * 32 ip_start, atom_end * 32 + 31 ip_end from rn")
def _(r: Run):
    return r.runs[1].select("run", "atom_end", "run_len", "short_run", "ip_start", "ip_end")


@query("e1_pre_profile", f"select block, {_PROFILE} from pre")
def _(r: Run):
    return _profile(r.pre, "block")


@query("e6_drop_decision", "select block, valid_cnt > 0 keep_flag, case when valid_cnt = 0 then 'ALL_ABNORMAL_BLOCK' end drop_reason from pre")
def _(r: Run):
    return r.pre.select("block", "keep_flag", "drop_reason")


@query("e7_split_candidates", "select block, ip_start, ip_end from cand")
def _(r: Run):
    return S.candidates(r.pre).select("block", "ip_start", "ip_end")


@query("e8_keep_members", "select ip, block from kept")
def _(r: Run):
    return r.kept.select("ip", "block")


@query("e10_final_profile", f"select final, block, {_PROFILE} from fin")
def _(r: Run):
    return _profile(r.final, "final", "block")


@query("f3_boundary_windows", "select block, bucket64, l_cnt, r_cnt, cast(l_reports as bigint) l_reports, cast(r_reports as bigint) r_reports, cast(l_mobile as bigint) l_mobile, cast(r_mobile as bigint) r_mobile, l_op, r_op from met")
def _(r: Run):
    return r.events.select("block", "bucket64", "l_cnt", "r_cnt", "l_reports", "r_reports", "l_mobile", "r_mobile", "l_op", "r_op")


@query("f10_split_events", "select block, bucket64, cut_ip, round(ratio_report, 6) ratio_report, round(cv_l, 6) cv_l, round(cv_r, 6) cv_r, round(mobile_diff, 6) mobile_diff, round(mobile_ratio, 6) mobile_ratio, round(device_ratio, 6) device_ratio, trigger_report, trigger_mobile, trigger_operator, trigger_density from ev")
def _(r: Run):
    return r.events.select("block", "bucket64", "cut_ip", *[F.round(c, 6).alias(c) for c in ("ratio_report", "cv_l", "cv_r", "mobile_diff", "mobile_ratio", "device_ratio")], "trigger_report", "trigger_mobile", "trigger_operator", "trigger_density")


@query("f11_void_zones", "select block, bucket64, trigger_void, trigger_report or trigger_mobile or trigger_operator or trigger_density or trigger_void is_cut from ev")
def _(r: Run):
    return r.events.select("block", "bucket64", "trigger_void", "is_cut")


@query("f15_final_blocks", "select final, block, row_number() over (partition by block order by final) segment_seq, ip_start, ip_end, member_cnt from fin")
def _(r: Run):
    return r.final.select("final", "block", F.row_number().over(Window.partitionBy("block").orderBy("final")).alias("segment_seq"), "ip_start", "ip_end", "member_cnt")


@query("f16_member_final", "select ip, block, segment, final from fm")
def _(r: Run):
    return r.final_members.select("ip", "block", "segment", "final")


@query("f17_split_stats", "select count(*) events, count(*) filter (l_cnt = 0 or r_cnt = 0) empty_side, count(*) filter (trigger_report or trigger_mobile or trigger_operator or trigger_density or trigger_void) cuts from ev")
def _(r: Run):
    return r.events.agg(F.count(F.lit(1)).alias("events"), F.count_if((F.col("l_cnt") == 0) | (F.col("r_cnt") == 0)).alias("empty_side"), F.count_if("is_cut").alias("cuts"))


@query("g1_h_blocks", "select final, tier, valid_cnt, member_cnt from hb")
def _(r: Run):
    return r.h_blocks.select("final", "tier", "valid_cnt", "member_cnt")


@query("g2_h_members", "select ip, final from h")
def _(r: Run):
    return r.h.select("ip", "final")


@query("g3_r1_members", "select ip, atom27, final from r1")
def _(r: Run):
    return r.r1.select("ip", "atom27", "final")


@query("g4_e_members", "select ip, atom27, run from e")
def _(r: Run):
    return r.e.select("ip", "atom27", "run")


@query("g5_f_members", "select ip, atom27 from f")
def _(r: Run):
    return r.f.select("ip", "atom27")


@query("g9_library", "select ip, lib from lab")
def _(r: Run):
    return r.labelled.select("ip", "lib")


_TOP = "(select {k}, operator, count(*) c, row_number() over (partition by {k} order by count(*) desc, operator) r from {t} where operator is not null and operator <> '' group by 1, 2)"


def _summary(members: DataFrame, key: str) -> DataFrame:
    """Sums over valid members per group, counts of all, and the operator most seen (ties: first in name)."""
    sums = [F.coalesce(F.sum(F.when(F.col("is_valid"), F.col(m))), F.lit(0)).alias(m) for m in ("reports", "devices", "mobile", "wifi")]
    out = members.groupBy(key).agg(F.count(F.lit(1)).alias("ip_count"), F.count_if(~F.col("is_valid")).alias("abnormal_ip_count"), *sums)
    ops = members.where("operator is not null and operator <> ''").groupBy(key, "operator").agg(F.count(F.lit(1)).alias("c"))
    top = ops.groupBy(key).agg(F.min(F.struct((-F.col("c")).alias("neg"), "operator")).alias("t"), F.count(F.lit(1)).alias("operators"))
    out = out.join(top.select(key, F.col("t.operator").alias("top_operator"), "operators"), key, "left")
    share = lambda a, b: F.coalesce(F.round(S.ratio(F.col(a), F.col(b)), 4), F.lit(0.0))
    return out.withColumns({"avg_devices": F.round(F.col("devices") / F.col("ip_count"), 4), "mobile_ratio": share("mobile", "devices"), "report_ratio": share("reports", "devices")})


def _summary_sql(k: str, t: str) -> str:
    return f"select s.*, top_operator, operators, round(devices / ip_count, 4) avg_devices, coalesce(round(mobile / nullif(devices, 0), 4), 0) mobile_ratio, coalesce(round(reports / nullif(devices, 0), 4), 0) report_ratio from (select {k}, count(*) ip_count, count(*) filter (not is_valid) abnormal_ip_count, cast(coalesce(sum(reports) filter (is_valid), 0) as bigint) reports, cast(coalesce(sum(devices) filter (is_valid), 0) as bigint) devices, cast(coalesce(sum(mobile) filter (is_valid), 0) as bigint) mobile, cast(coalesce(sum(wifi) filter (is_valid), 0) as bigint) wifi from {t} group by 1) s left join (select {k}, max(case when r = 1 then operator end) top_operator, count(*) operators from {_TOP.format(k=k, t=t)} group by 1) o using ({k})"


@query("h1_block_summary", _summary_sql("final", "h"))
def _(r: Run):
    return _summary(r.h, "final")


@query("h5_run_summary", _summary_sql("run", "e"))
def _(r: Run):
    return _summary(r.e, "run")


@query("h6_address_summary", "select ip, operator, is_valid, reports, devices, coalesce(round(mobile / nullif(devices, 0), 4), 0) mobile_ratio, coalesce(round(reports / nullif(devices, 0), 4), 0) report_ratio from f")
def _(r: Run):
    share = lambda a: F.coalesce(F.round(S.ratio(F.col(a), F.col("devices")), 4), F.lit(0.0))
    return r.f.select("ip", "operator", "is_valid", "reports", "devices", share("mobile").alias("mobile_ratio"), share("reports").alias("report_ratio"))


@query("j1_library_kpis", "select lib, count(*) members, count(*) filter (is_valid) valid, quantile_cont(reports, 0.5) reports_p50, quantile_cont(reports, 0.9) reports_p90, quantile_cont(devices, 0.5) devices_p50, quantile_cont(devices, 0.9) devices_p90, round(count(*) filter (is_valid) / count(*), 6) valid_share, round(avg(mobile / nullif(devices, 0)), 6) mobile_share from lab group by 1")
def _(r: Run):
    own = r.labelled
    out = own.groupBy("lib").agg(F.count(F.lit(1)).alias("members"), F.count_if("is_valid").alias("valid"), F.round(F.count_if("is_valid") / F.count(F.lit(1)), 6).alias("valid_share"), F.round(F.avg(S.ratio(F.col("mobile"), F.col("devices"))), 6).alias("mobile_share"))
    out = out.join(ranks.percentiles(own, "lib", "reports", {"reports_p50": 0.5, "reports_p90": 0.9}), "lib")
    return out.join(ranks.percentiles(own, "lib", "devices", {"devices_p50": 0.5, "devices_p90": 0.9}), "lib")


@query("j2_top_operators", "select lib, operator, n, round(n / total, 6) share, r as rank from (select lib, operator, count(*) n, sum(count(*)) over (partition by lib) total, row_number() over (partition by lib order by count(*) desc, operator) r from lab group by 1, 2) where r <= 5")
def _(r: Run):
    w = Window.partitionBy("lib")
    n = r.labelled.groupBy("lib", "operator").agg(F.count(F.lit(1)).alias("n")).withColumns({"total": F.sum("n").over(w), "rank": F.row_number().over(w.orderBy(F.desc("n"), "operator"))})
    return n.where("rank <= 5").select("lib", "operator", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), "rank")


@query("j5_atom_histogram", "select valid_cnt, count(*) atoms from atm group by 1")
def _(r: Run):
    return r.atoms.groupBy("valid_cnt").agg(F.count(F.lit(1)).alias("atoms"))


@query("j16_tier_drift", "select p.tier pre_tier, f.tier final_tier, count(*) blocks, cast(sum(f.member_cnt) as bigint) members from fin f join pre p on p.block = f.block group by 1, 2")
def _(r: Run):
    pre = r.pre.select("block", F.col("tier").alias("pre_tier"))
    return r.final.join(pre, "block").groupBy("pre_tier", F.col("tier").alias("final_tier")).agg(F.count(F.lit(1)).alias("blocks"), F.sum("member_cnt").alias("members"))


@query("j17_trigger_mix", "select trigger_report, trigger_mobile, trigger_operator, trigger_density, trigger_void, count(*) n, round(avg(abs(cv_l - cv_r)), 6) cv_gap from ev group by all")
def _(r: Run):
    t = ["trigger_report", "trigger_mobile", "trigger_operator", "trigger_density", "trigger_void"]
    return r.events.groupBy(*t).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col("cv_l") - F.col("cv_r"))), 6).alias("cv_gap"))


@query("j20_whatif_density", "select tier, new_tier, count(*) blocks from (select *, case when valid_cnt = 0 then 'invalid' when wa + nd >= 40 then 'xlarge' when wa + nd >= 30 then 'large' when wa + nd >= 20 then 'medium' when wa + nd >= 10 then 'small' else 'micro' end new_tier from (select *, case when devices_valid <= 2*valid_cnt then 1 when devices_valid <= 5*valid_cnt then 2 when devices_valid <= 20*valid_cnt then 4 when devices_valid <= 100*valid_cnt then 16 else 32 end nd from fin)) group by 1, 2")
def _(r: Run):
    again = S.scored(r.final.withColumn("was", F.col("tier")), ((2, 1), (5, 1), (20, 1), (100, 1)))
    return again.groupBy(F.col("was").alias("tier"), F.col("tier").alias("new_tier")).agg(F.count(F.lit(1)).alias("blocks"))


@query("j31_tiers", "select tier, count(*) blocks, cast(sum(member_cnt) as bigint) members from fin group by 1")
def _(r: Run):
    return r.final.groupBy("tier").agg(F.count(F.lit(1)).alias("blocks"), F.sum("member_cnt").alias("members"))


@query("k2_disjoint", "select (select count(*) from h join e using (ip)) h_e, (select count(*) from h join f using (ip)) h_f, (select count(*) from e join f using (ip)) e_f")
def _(r: Run):
    per = r.labelled.groupBy("ip").agg(F.collect_set("lib").alias("l"))
    both = lambda a, b: F.count_if(F.array_contains("l", a) & F.array_contains("l", b))
    return per.agg(both("H", "E").alias("h_e"), both("H", "F").alias("h_f"), both("E", "F").alias("e_f"))


@query("k3_conservation", "select count(*) filter (lib = 'H') h, count(*) filter (lib = 'E') e, count(*) filter (lib = 'F') f, count(*) filter (lib = 'D') d, (select count(*) from mem) members, count(*) = (select count(*) from mem) conserved from lab")
def _(r: Run):
    of = lambda x: F.count_if(F.col("lib") == x)
    total = r.members.agg(F.count(F.lit(1)).alias("members"))
    got = r.labelled.agg(of("H").alias("h"), of("E").alias("e"), of("F").alias("f"), of("D").alias("d"), F.count(F.lit(1)).alias("n"))
    return got.crossJoin(total).select("h", "e", "f", "d", "members", (F.col("n") == F.col("members")).alias("conserved"))  # one row each


@query("a8_country_bytes", "select country, hex(country) bytes, count(*) n from src group by all")
def _(r: Run):
    return r.source.groupBy("country", F.hex(F.encode("country", "UTF-8")).alias("bytes")).agg(F.count(F.lit(1)).alias("n"))


@query("b11_operator_contains", "select ip, operator from mem where operator ilike '%o%'")
def _(r: Run):
    return r.members.where(F.col("operator").ilike("%o%")).select("ip", "operator")


@query("c2_refined_histogram", "select 20 bits, p20 prefix, n from c20 where n <= (select avg(n) * 1.1 from c20) union all select 24, ip >> 8, count(*) from mem where ip >> 12 in (select p20 from c20 where n > (select avg(n) * 1.1 from c20)) group by 2".replace("c20", "(select ip >> 12 p20, count(*) n from mem group by 1)"))
def _(r: Run):
    coarse = r.members.groupBy(F.shiftright("ip", 12).alias("p20")).agg(F.count(F.lit(1)).alias("n"))
    coarse = coarse.withColumn("hot", F.col("n") > F.avg("n").over(Window.partitionBy()) * 1.1)  # one row a prefix, 2^20 at most
    fine = r.members.withColumn("p20", F.shiftright("ip", 12)).join(coarse.where("hot").select("p20"), "p20", "left_semi").groupBy(F.shiftright("ip", 8).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    return coarse.where("not hot").select(F.lit(20).alias("bits"), F.col("p20").alias("prefix"), "n").unionByName(fine.select(F.lit(24).alias("bits"), "prefix", "n"))


@query("c5_equal_spans", "select (ip - lo) // step shard, lo + (ip - lo) // step * step span_start, count(*) n from mem, (select min(ip) lo, (max(ip) - min(ip)) // 8 + 1 step from mem) group by 1, 2")
def _(r: Run):
    span = r.members.agg(F.min("ip").alias("lo"), F.expr("(max(ip) - min(ip)) div 8 + 1").alias("step"))
    return r.members.crossJoin(F.broadcast(span)).groupBy(F.expr("(ip - lo) div step").alias("shard"), F.expr("lo + (ip - lo) div step * step").alias("span_start")).agg(F.count(F.lit(1)).alias("n"))  # span is one row


def pieces(e: DataFrame) -> DataFrame:
    """(run, p16, piece, ip_start, ip_end, members): runs of more than 256 rows by 2^16 addresses and then by 256 rows, others whole.

    Every run is cut as a large one; the pieces of the others, a row or few each, become one.
    """
    e = e.select("run", "ip", F.shiftright("ip", 16).alias("p16")).withColumn("piece", F.expr("(row_number() over (partition by run, p16 order by ip) - 1) div 256"))
    p = e.groupBy("run", "p16", "piece").agg(F.min("ip").alias("ip_start"), F.max("ip").alias("ip_end"), F.count(F.lit(1)).alias("members"))
    p = p.withColumn("large", F.sum("members").over(Window.partitionBy("run")) > 256)
    p = p.groupBy("run", F.when(F.col("large"), F.col("p16")).alias("p16"), F.when(F.col("large"), F.col("piece")).otherwise(F.lit(0).cast("long")).alias("piece"))
    return p.agg(F.min("ip_start").alias("ip_start"), F.max("ip_end").alias("ip_end"), F.sum("members").alias("members"))


@query("d7_run_pieces", "select run, p16, piece, min(ip) ip_start, max(ip) ip_end, count(*) members from (select run, ip, p16, (row_number() over (partition by run, p16 order by ip) - 1) // 256 piece from (select run, ip, case when count(*) over (partition by run) > 256 then ip >> 16 end p16 from e)) group by 1, 2, 3")
def _(r: Run):
    return pieces(r.e)


_STATS_SQL = "select count(*) blocks, count(*) filter (valid_cnt = 0) invalid, round(avg(member_cnt), 6) mean_members, round(quantile_cont(devices_valid / nullif(valid_cnt, 0), 0.5), 6) density_p50, round(quantile_cont(devices_valid / nullif(valid_cnt, 0), 0.9), 6) density_p90, round(quantile_cont(devices_valid / nullif(valid_cnt, 0), 0.99), 6) density_p99, round(quantile_cont(mobile_valid / nullif(devices_valid, 0), 0.5), 6) mobile_p50, round(quantile_cont(worktime_valid / nullif(reports_valid, 0), 0.5), 6) worktime_p50 from "


def _stats(df: DataFrame) -> DataFrame:
    one = df.withColumns({"every": F.lit(0), "mobile_share": S.ratio(F.col("mobile_valid"), F.col("devices_valid")), "worktime_share": S.ratio(F.col("worktime_valid"), F.col("reports_valid"))})
    out = one.groupBy("every").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("valid_cnt") == 0).alias("invalid"), F.round(F.avg("member_cnt"), 6).alias("mean_members"))
    for c, wanted in (("density", {"density_p50": 0.5, "density_p90": 0.9, "density_p99": 0.99}), ("mobile_share", {"mobile_p50": 0.5}), ("worktime_share", {"worktime_p50": 0.5})):
        q = ranks.percentiles(one, "every", c, wanted, scale=1 << 20)
        out = out.join(q.select("every", *[F.round(n, 6).alias(n) for n in wanted]), "every", "left")
    return out.drop("every")


@query("e9_pre_stats", _STATS_SQL + "pre")
def _(r: Run):
    return _stats(r.pre)


@query("e11_final_stats", _STATS_SQL + "fin")
def _(r: Run):
    return _stats(r.final)


@query("h4_h_with_profile", "select final, ip_count, tier, score, round(devices_valid / nullif(valid_cnt, 0), 6) density, valid_cnt from (select final, count(*) ip_count from h group by 1) join fin using (final)")
def _(r: Run):
    return r.h.groupBy("final").agg(F.count(F.lit(1)).alias("ip_count")).join(r.final, "final").select("final", "ip_count", "tier", "score", F.round("density", 6).alias("density"), "valid_cnt")


@query("j9_thin_runs", "select run, count(*) run_len, round(avg(valid_cnt), 6) mean_valid from ps group by 1 having count(*) >= 3 and avg(valid_cnt) < 20")
def _(r: Run):
    return r.runs[0].groupBy("run").agg(F.count(F.lit(1)).alias("run_len"), F.avg("valid_cnt").alias("m")).where("run_len >= 3 and m < 20").select("run", "run_len", F.round("m", 6).alias("mean_valid"))


@query("j10_near_miss", "select ip, atom27, valid_cnt from f join atm using (atom27) where valid_cnt >= 5")
def _(r: Run):
    return r.f.join(r.atoms.where("valid_cnt >= 5").select("atom27", "valid_cnt"), "atom27").select("ip", "atom27", "valid_cnt")


@query("j11_h_flow", "select tier, n > 1 was_split, count(*) blocks, cast(sum(member_cnt) as bigint) members from pre join (select block, count(*) n from fin group by 1) using (block) group by 1, 2")
def _(r: Run):
    parts = r.final.groupBy("block").agg((F.count(F.lit(1)) > 1).alias("was_split"))
    return r.pre.join(parts, "block").groupBy("tier", "was_split").agg(F.count(F.lit(1)).alias("blocks"), F.sum("member_cnt").alias("members"))


_ATOM_RUNS = "(select atom27, valid_cnt, valid_cnt >= 7 dense, coalesce(not short_run, false) in_run from atm left join (select atom27, run from ps) using (atom27) left join rn using (run))"


def _atom_runs(r: Run) -> DataFrame:
    passing, runs = r.runs
    long = passing.join(runs.where("not short_run").select("run"), "run", "left_semi").select("atom27", F.lit(True).alias("in_run"))
    return r.atoms.join(long, "atom27", "left").select("atom27", "valid_cnt", F.col("is_e_atom").alias("dense"), F.coalesce("in_run", F.lit(False)).alias("in_run"))


@query("j12_atom_flow", f"select dense, in_run, count(*) atoms, cast(sum(valid_cnt) as bigint) valid from {_ATOM_RUNS} group by 1, 2")
def _(r: Run):
    return _atom_runs(r).groupBy("dense", "in_run").agg(F.count(F.lit(1)).alias("atoms"), F.sum("valid_cnt").alias("valid"))


@query("j13_h_edges", "select count(*) filter (devices_valid between 28 * valid_cnt and 32 * valid_cnt and valid_cnt > 0) density_band, count(*) filter (score between 18 and 22) score_band, count(*) filter (member_cnt >= 100 and 2 * valid_cnt < member_cnt) mostly_abnormal from fin")
def _(r: Run):
    return r.final.agg(F.count_if(F.expr("devices_valid between 28 * valid_cnt and 32 * valid_cnt and valid_cnt > 0")).alias("density_band"), F.count_if(F.expr("score between 18 and 22")).alias("score_band"), F.count_if(F.expr("member_cnt >= 100 and 2 * valid_cnt < member_cnt")).alias("mostly_abnormal"))


@query("j14_run_lengths", "select run_len, count(*) runs from rn where run_len <= 5 group by 1")
def _(r: Run):
    return r.runs[1].where("run_len <= 5").groupBy("run_len").agg(F.count(F.lit(1)).alias("runs"))


@query("j15_f_composition", f"select count(*) filter (not dense) fail_density, count(*) filter (dense and not in_run) fail_run from {_ATOM_RUNS} where atom27 in (select atom27 from f)")
def _(r: Run):
    inside = _atom_runs(r).join(r.f.select("atom27").distinct(), "atom27", "left_semi")
    return inside.agg(F.count_if(~F.col("dense")).alias("fail_density"), F.count_if(F.col("dense") & ~F.col("in_run")).alias("fail_run"))


_WHATIF = "select {v} least_valid, {l} least_run, count(*) runs, cast(sum(n) as bigint) atoms from (select count(*) n from (select atom27 - row_number() over (order by atom27) g from atm where valid_cnt >= {v}) group by g) where n >= {l}"


@query("j21_whatif_runs", " union all ".join(_WHATIF.format(v=v, l=least) for v, least in ((7, 3), (5, 2))))
def _(r: Run):
    def tried(v: int, least: int) -> DataFrame:
        runs = S.runs(S.atoms(r.r1, v), least)[1].where("not short_run")
        return runs.agg(F.lit(v).alias("least_valid"), F.lit(least).alias("least_run"), F.count(F.lit(1)).alias("runs"), F.sum("run_len").alias("atoms"))

    return tried(7, 3).unionByName(tried(5, 2))


@query("j26_block_detail", "select 'final' kind, final id, ip_start, ip_end, tier, score from fin union all select 'natural', block, ip_start, ip_end, tier, score from pre")
def _(r: Run):
    part = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "ip_start", "ip_end", "tier", "score")
    return part(r.final, "final", "final").unionByName(part(r.pre, "natural", "block"))


@query("j30_shard_matrix", "select ip >> 12 shard, count(*) members, count(*) filter (lib = 'H') h, count(*) filter (lib = 'E') e, count(*) filter (lib = 'F') f, count(*) filter (lib = 'D') d from lab group by 1")
def _(r: Run):
    return r.labelled.groupBy(F.shiftright("ip", 12).alias("shard")).agg(F.count(F.lit(1)).alias("members"), *[F.count_if(F.col("lib") == x).alias(x.lower()) for x in "HEFD"])


@query("k4_no_ghosts", "select count(*) ghosts from lab where lib <> 'D' and ip not in (select ip from mem)")
def _(r: Run):
    found = r.h.select("ip").unionByName(r.e.select("ip")).unionByName(r.f.select("ip"))
    return found.join(r.members, "ip", "left_anti").agg(F.count(F.lit(1)).alias("ghosts"))


@query("k5_dropped_mapped", "select count(*) dropped, count(*) filter (ip not in (select ip from blk)) unmapped from mem where ip not in (select ip from fm)")
def _(r: Run):
    # merge: the small files of staged addresses would have Spark send them all through the driver
    gone = r.members.select("ip").join(r.final_members.select("ip").hint("merge"), "ip", "left_anti").join(r.blocked.select("ip", "block").hint("merge"), "ip", "left")
    return gone.agg(F.count(F.lit(1)).alias("dropped"), F.count_if(F.col("block").isNull()).alias("unmapped"))


@query("k6_h_valid", "select count(*) filter (tier = 'invalid') invalid_tiers, count(*) filter (valid_cnt < 4) too_few from hb")
def _(r: Run):
    return r.h_blocks.agg(F.count_if(F.col("tier") == "invalid").alias("invalid_tiers"), F.count_if(F.col("valid_cnt") < 4).alias("too_few"))


@query("k7_f_outside_e", "select count(*) hits from f where atom27 in (select atom27 from e)")
def _(r: Run):
    return r.f.join(r.e.select("atom27").distinct(), "atom27", "left_semi").agg(F.count(F.lit(1)).alias("hits"))


@query("k8_empty_sides", "select count(*) filter (l_cnt = 0 or r_cnt = 0) empty_sides, count(*) filter (l_cnt = 0 or r_cnt = 0) > 0 warn from ev")
def _(r: Run):
    n = F.count_if((F.col("l_cnt") == 0) | (F.col("r_cnt") == 0))
    return r.events.agg(n.alias("empty_sides"), (n > 0).alias("warn"))


@query("j29_overview", "select (select count(*) from mem) members, (select count(*) from pre) blocks, (select count(*) from ev) events, (select count(*) from fin) final_blocks, (select count(*) from hb) h_blocks, (select count(*) from rn where not short_run) e_runs")
def _(r: Run):
    n = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    parts = {"members": r.members, "blocks": r.pre, "events": r.events, "final_blocks": r.final, "h_blocks": r.h_blocks, "e_runs": r.runs[1].where("not short_run")}
    rows = [n(df, kind) for kind, df in parts.items()]
    every = rows[0]
    for x in rows[1:]:
        every = every.unionByName(x)
    return every.agg(*[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in parts])


@query("k11_member_flow", "select ip >> 12 shard, count(*) kept, count(*) filter (ip in (select ip from h)) h, count(*) filter (ip in (select ip from r1)) r1, count(*) filter (ip in (select ip from e)) + count(*) filter (ip in (select ip from f)) e_f from fm group by 1")
def _(r: Run):
    n = lambda df, name: df.groupBy(F.shiftright("ip", 12).alias("shard")).agg(F.count(F.lit(1)).alias(name))
    out = n(r.final_members, "kept")
    for df, name in ((r.h, "h"), (r.r1, "r1"), (r.e.select("ip").unionByName(r.f.select("ip")), "e_f")):
        out = out.join(n(df, name), "shard", "left")
    return out.fillna(0)
