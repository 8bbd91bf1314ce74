"""Queries that complete earlier ones: bad quads, coarse histograms, whole funnels and reference ranges, the validation row, and tags that all fire."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockloom.operators import rules, statistics
from blockloom.operators import segments as S
from blockloom.plans import further, research, tagsets
from blockloom.plans.queries import query
from blockloom.plans.run import Run
from blockloom.plans.wide import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

_QUADS = "case k % 9 when 0 then '1.2.3' when 1 then '256.1.1.1' when 2 then 'a.b.c.d' when 3 then '1.2.3.4.5' when 4 then concat(' 10.0.0.', cast(k % 256 as {text})) when 5 then '' when 6 then null when 7 then '1.2.3.0400' else concat('010.', cast(k % 256 as {text}), '.0.', cast(k % 300 as {text})) end"


_PART = [f"try_cast(string_split(quad, '.')[{i}] as bigint)" for i in range(1, 5)]


@query("b5_bad_quads", f"select k, quad, case when regexp_full_match(quad, '\\d{{1,3}}(\\.\\d{{1,3}}){{3}}') and greatest({', '.join(_PART)}) <= 255 then {_PART[0]} * 16777216 + {_PART[1]} * 65536 + {_PART[2]} * 256 + {_PART[3]} end ip from (select k, {_QUADS.format(text='varchar')} quad from (select o_orderkey k from orders))")
def _(r: Run):
    """Texts of which most aren't addresses; these give null."""
    keys = r.spark.read.parquet(f"{r.sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    return keys.withColumn("quad", F.expr(_QUADS.format(text="string"))).withColumn("ip", S.from_dotted(F.col("quad")))


@query("c1_prefix16", "select ip >> 16 prefix, count(*) n, count(*) filter (is_valid) valid from mem group by 1")
def _(r: Run):
    return r.members.groupBy(F.shiftright("ip", 16).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("valid"))


@query("f17_whole_split_stats", "select (select count(*) from ev) events, (select count(*) from ev where l_cnt = 0 or r_cnt = 0) empty_side, (select count(*) from cuts) cuts, (select count(*) from jump) inner_cuts, (select count(distinct final) from fm) final_blocks, (select count(distinct block) from fm) parents")
def _(r: Run):
    blocks = r.final_members.agg(F.countDistinct("block").alias("parents"), F.countDistinct("segment").alias("segments"), F.countDistinct("final").alias("final_blocks"))
    events = r.events.agg(F.count(F.lit(1)).alias("events"), F.count_if((F.col("l_cnt") == 0) | (F.col("r_cnt") == 0)).alias("empty_side"), F.count_if("is_cut").alias("cuts"))
    both = events.crossJoin(blocks)  # one row each
    return both.select("events", "empty_side", "cuts", (F.col("final_blocks") - F.col("segments")).alias("inner_cuts"), "final_blocks", "parents")


_MEASURES = {"member_cnt": "member_cnt", "devices_valid": "devices_valid", "reports_valid": "reports_valid", "abnormal_cnt": "member_cnt - valid_cnt"}
_TOOK = ", ".join(f"coalesce(cast(sum({x}) as bigint), 0) {n}" for n, x in _MEASURES.items())
_LEFT = ", ".join(f"cast((select sum({x}) from fin) - sum({n}) over w as bigint) {n}_left" for n, x in _MEASURES.items())


@query("i4_whole_funnel", f", tagged as (select *, {research._TAG_SQL} tag from fin), took as (select step, tag, count(t2.final) as rows, {_TOOK} from (values {research._FUNNEL}) s(step, tag) left join (select tag tag2, * exclude (tag) from tagged) t2 on tag2 = s.tag group by 1, 2) select step, tag, rows, {', '.join(_MEASURES)}, (select count(*) from fin) - cast(sum(rows) over w as bigint) rows_left, {_LEFT} from took window w as (order by step)")
def _(r: Run):
    return rules.funnel(r.final.withColumn("abnormal_cnt", F.col("member_cnt") - F.col("valid_cnt")), research.TAGS, list(_MEASURES))


_BAND = "case when 2 * devices_valid <= 7 * valid_cnt then 0 when devices_valid <= 30 * valid_cnt then 1 when devices_valid <= 200 * valid_cnt then 2 else 3 end"
_NET = "case when 2 * mobile_valid > devices_valid then 0 when 2 * wifi_valid > devices_valid then 1 else 2 end"
_RANGES = {"reports": "reports_valid / valid_cnt", "devices": "devices_valid / valid_cnt", "members": "member_cnt", "worktime": "worktime_valid / nullif(reports_valid, 0)", "late_night": "late_night_valid / nullif(reports_valid, 0)"}


@query("i10_reference_ranges", f"select metric, band, network, count(v) n, round(quantile_cont(v, 0.05), 6) p05, round(quantile_cont(v, 0.5), 6) p50 from ({' union all '.join(f'select {chr(39)}{m}{chr(39)} metric, {_BAND} band, {_NET} network, cast({x} as double) v from fin where valid_cnt > 0' for m, x in _RANGES.items())}) where v is not null group by 1, 2, 3")
def _(r: Run):
    """What blocks of a density band (0 to 3) and a network (0 mobile, 1 wifi, 2 other) have: the range that anomalies are held against."""
    blocks = r.final.where("valid_cnt > 0")
    counts = statistics.counted(blocks, {m: F.expr(x) for m, x in _RANGES.items()}, F.expr(f"3 * {_BAND} + {_NET}"))
    found = statistics.summed_up(counts, {"p05": 0.05, "p50": 0.5}).where(F.col("shard") != statistics.EVERYWHERE)
    wide = found.groupBy("metric", "shard").pivot("stat", ["count", "p05", "p50"]).agg(F.first("value"))
    return wide.select("metric", F.expr("cast(shard div 3 as int)").alias("band"), (F.col("shard") % 3).cast("int").alias("network"), F.col("count").cast("long").alias("n"), "p05", "p50")


_ONE = {"h_e": "no_overlap_h_e", "h_f": "no_overlap_h_f", "e_f": "no_overlap_e_f", "lost": "conservation", "ghosts": "no_ghosts"}
_FAILED = lambda s: " + ".join(f"(({q}) > 0)::int" for n, q in further._GATE.items() if (n == "empty_sides") == (s == "WARN"))


@query("k12_validation_row", f", parts as (select ip from h union all select ip from e union all select ip from f) select (select count(*) from fm) kept, (select count(*) from h) h, (select count(*) from r1) r1, (select count(*) from e) e, (select count(*) from f) f, {', '.join(f'({further._GATE[n]}) {c}' for c, n in _ONE.items())}, (select count(*) from fm) = (select count(*) from h) + (select count(*) from r1) keep_equal, (select count(*) from r1) = (select count(*) from e) + (select count(*) from f) r1_equal, (select count(*) from e where run in (select run from rn where short_run)) short_leaks, {_FAILED('STOP')} stop_failed, {_FAILED('WARN')} warn_failed")
def _(r: Run):
    """Counts, overlaps, equalities, leaks and failed checks of a run in one row."""
    own = research.mainline_row(r)
    checked = further.checks(r)
    pick = lambda n: F.max(F.when(F.col("name") == n, F.col("failures")))
    failed = lambda s: F.count_if(~F.col("passed") & (F.col("severity") == s))
    gate = checked.agg(*[pick(n).alias(c) for c, n in _ONE.items()], failed("STOP").alias("stop_failed"), failed("WARN").alias("warn_failed"))
    return own.crossJoin(gate)  # one row each


# --- tags that all fire

_OPERATORS = [*tagsets.CARRIERS.values(), tagsets.CABLE, tagsets.CABLES[3], tagsets.CLOUDS[0], "另外"]
_LEVELS = {
    "mobile_device_ratio": [0.05, 0.05, 0.2, 0.4, 0.85, 0.95], "wifi_device_ratio": [0.1, 0.8, 0.9, 0.97], "daa_dna_ratio": [2, 3, 5, 6, 9], "avg_apps_per_device": [0.05, 0.1, 1], "avg_apps_per_ip": [3, 4, 5, 12],
    "avg_devices_per_ip": [3, 5, 20, 50], "android_device_ratio": [0.5, 0.5, 0.9, 0.5, 1.2], "android_oaid_ratio": [0.5, 1.0, 0.5, 0.5, 1.5], "report_oaid_ratio": [5, 5, 20, 25], "root_report_ratio": [0, 0.1, 0, 0.2, 0], "workday_report_ratio": [0.5, 0.65, 0.7, 0.8, 0.9], "late_night_report_ratio": [0.01, 0.03, 0.05, 0.2],
}


def _level(i: int, values: list) -> str:
    text = lambda v: f"'{v}'" if isinstance(v, str) else f"cast({v} as double)"
    return f"case (o_orderkey * {7919 + 2 * i} + {101 * i}) % 10007 % {len(values)} " + " ".join(f"when {j} then {text(v)}" for j, v in enumerate(values)) + " end"


_PROFILES = "select o_orderkey k, " + ", ".join(f"{_level(i, v)} {n}" for i, (n, v) in enumerate({"top_operator": _OPERATORS, **_LEVELS}.items())) + " from orders"
#: The thresholds by hand, apart from the rule data.
_CLOUDS = "top_operator in ('阿里云', '腾讯云', '华为云', '百度云', '亚马逊', '微软', '京东云', '天翼云', 'UCloud', '金山云')"
_FIXED_LINE = "wifi_device_ratio >= 0.9 and daa_dna_ratio >= 6 and avg_apps_per_device >= 0.1"
_H = f"""case when top_operator = '中国移动' and mobile_device_ratio >= 0.85 and daa_dna_ratio >= 8 and avg_apps_per_ip >= 5 and avg_devices_per_ip >= 20 then 'mobile_cmcc'
when top_operator = '中国联通' and mobile_device_ratio >= 0.85 and daa_dna_ratio >= 8 and avg_apps_per_ip >= 5 and avg_devices_per_ip >= 20 then 'mobile_unicom'
when top_operator = '中国电信' and mobile_device_ratio >= 0.85 and daa_dna_ratio >= 3 and avg_apps_per_ip >= 5 and avg_devices_per_ip >= 5 then 'mobile_telecom'
when mobile_device_ratio >= 0.1 and daa_dna_ratio >= 5 and avg_apps_per_ip >= 5 then 'network_mixed' when {_CLOUDS} then 'cloud_proxy' when android_device_ratio >= 1.2 or android_oaid_ratio >= 1.5 then 'android_id_anomaly'
when avg_apps_per_ip <= 3 or report_oaid_ratio > 20 then 'app_fraud' when daa_dna_ratio < 3 then 'device_fraud' when top_operator = '中国电信' and {_FIXED_LINE} then 'wifi_telecom' when top_operator = '中国移动' and {_FIXED_LINE} then 'wifi_cmcc'
when top_operator = '中国联通' and {_FIXED_LINE} then 'wifi_unicom' when {_FIXED_LINE} then 'wifi_other' end"""
_OFFICE = "workday_report_ratio >= 0.65 and workday_report_ratio <= 0.8 and late_night_report_ratio >= 0.05 and wifi_device_ratio >= 0.9"
_ORDER = {"telecom": "中国电信", "unicom": "中国联通", "cmcc": "中国移动"}
_E = f"case when {_CLOUDS} then 'cloud_service' when root_report_ratio >= 0.2 then 'root_anomaly' " + " ".join(
    [f"when top_operator = '{n}' and mobile_device_ratio >= 0.85 and daa_dna_ratio >= 3 then 'mobile_{c}'" for c, n in {**_ORDER, "guangdian": "广电网"}.items()] + [f"when top_operator = '{n}' and mobile_device_ratio >= 0.3 then 'scattered_mobile_{c}'" for c, n in _ORDER.items()] + [f"when top_operator = '{n}' and {_OFFICE} then 'broadband_{c}'" for c, n in _ORDER.items()]
) + " when wifi_device_ratio >= 0.9 and late_night_report_ratio >= 0.05 and top_operator in ('广电网', '东方有线') then 'broadband_guangdian' when wifi_device_ratio >= 0.9 and late_night_report_ratio >= 0.05 and mobile_device_ratio < 0.3 then 'broadband_other' end"
_F = f"case when {_CLOUDS} then 'cloud_service' when root_report_ratio >= 0.2 then 'root_anomaly' when mobile_device_ratio >= 0.85 and daa_dna_ratio >= 3 then 'mobile_exit' when workday_report_ratio >= 0.85 and late_night_report_ratio < 0.03 and wifi_device_ratio >= 0.8 then 'enterprise_line' when mobile_device_ratio >= 0.3 then 'scattered_mobile' when wifi_device_ratio >= 0.9 and late_night_report_ratio >= 0.05 then 'residential_broadband' end"


@query("i7_every_tag", f", p as ({_PROFILES}) select lib, tag, count(*) n, sum(k)::bigint keys from (select 'H' lib, {_H} tag, k from p union all select 'E', {_E}, k from p union all select 'F', {_F}, k from p) group by 1, 2")
def _(r: Run):
    """The three tag sets over profiles made from the orders, so that every tag is reached."""
    made = r.spark.read.parquet(f"{r.sf_dir}/orders.parquet").selectExpr("o_orderkey", "o_orderkey k", *[f"{_level(i, v)} {n}" for i, (n, v) in enumerate({"top_operator": _OPERATORS, **_LEVELS}.items())])
    out = None
    for lib, tags in (("H", tagsets.h_tags()), ("E", tagsets.e_tags()), ("F", tagsets.f_tags())):
        one = rules.tag(made, tags).groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys")).select(F.lit(lib).alias("lib"), "tag", "n", "keys")
        out = one if out is None else out.unionByName(one)
    return out
