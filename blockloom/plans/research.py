"""Further queries over a run: planning, rules and funnels, research listings, run state and quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.operators import ranks, rules
from blockloom.operators import segments as S
from blockloom.plans.queries import QUERIES, SQL, query, run_of, shard_plan
from blockloom.plans.run import Run
from blockloom.sources import runs as state
from blockloom.sources.stage import shared_dir

__all__ = ["QUERIES", "SQL"]

SHARD_BITS = 12
#: Fixed: a small tag set over final blocks, in order.
TAGS = [
    ("no_valid", {"field": "valid_cnt", "op": "=", "value": 0}),
    ("shared", {"all": [{"field": "tier", "op": "in", "value": ["large", "xlarge"]}, {"field": "devices_valid", "op": ">", "value": 200}]}),
    ("dense", {"field": "devices_valid", "op": ">=", "by": "valid_cnt", "bands": [(16, 100), (128, 800), (None, 3000)]}),
    ("mobile", {"needs": [{"field": "valid_cnt", "op": ">=", "value": 4}], "dims": [{"field": "mobile_valid", "op": ">", "value": 20}, {"field": "wifi_valid", "op": "<", "value": 20}, {"field": "reports_valid", "op": ">", "value": 900}], "failed": 2}),
    ("small", {"any": [{"field": "member_cnt", "op": "<=", "value": 2}, {"field": "tier", "op": "=", "value": "micro"}]}),
]
_TAG_SQL = """case when valid_cnt = 0 then 'no_valid' when tier in ('large', 'xlarge') and devices_valid > 200 then 'shared'
 when devices_valid >= (case when valid_cnt <= 16 then 100 when valid_cnt <= 128 then 800 else 3000 end) then 'dense'
 when valid_cnt >= 4 and (mobile_valid > 20)::int + (wifi_valid < 20)::int + (reports_valid > 900)::int >= 2 then 'mobile'
 when member_cnt <= 2 or tier = 'micro' then 'small' end"""


def count(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def _atoms_of(r: Run, run_id: str) -> DataFrame:
    return r.atoms.select(F.lit(run_id).alias("run_id"), F.expr("cast(atom27 div 128 as int)").alias("shard_id"), "atom27", "valid_cnt")


@query("a3_replace_shards", "select 'first' run_id, cast(atom27 // 128 as int) shard_id, atom27, valid_cnt from atm")
def _(r: Run):
    path = f"{shared_dir(r.spark)}/sink-{uuid.uuid4().hex}"
    rows = _atoms_of(r, "first")
    state.replace_shards(rows.withColumn("valid_cnt", F.lit(-1).cast("long")), path)
    state.replace_shards(rows, path)  # replaces all shards that the first write left
    return r.spark.read.parquet(path).select(F.col("run_id").cast("string").alias("run_id"), F.col("shard_id").cast("int").alias("shard_id"), "atom27", "valid_cnt")


@query("a5_purge_run", "select 'second' run_id, count(*) n from atm")
def _(r: Run):
    path = f"{shared_dir(r.spark)}/sink-{uuid.uuid4().hex}"
    for name in ("first", "second"):
        state.replace_shards(_atoms_of(r, name), path)
    state.purge_run(r.spark, path, "first")
    return r.spark.read.parquet(path).groupBy("run_id").agg(count())


@query("a9_latest_run", "select operator run_id from mem group by 1 order by max(ip) desc, 1 desc limit 1")
def _(r: Run):
    made = r.members.groupBy(F.col("operator").alias("run_id")).agg(F.max("ip").alias("created_at"))
    return state.latest_run(made)


@query("a10_readiness", "select operator run_id, count(*) as rows, count(nullif(mobile, 0)) complete, case when count(nullif(mobile, 0)) < count(*) then 'partial' else 'ready' end state from mem group by 1")
def _(r: Run):
    return state.readiness(r.members.select(F.col("operator").alias("run_id"), F.nullif("mobile", F.lit(0)).alias("mobile")), ["mobile"])


_PLAN = "(select shard, min(prefix) prefix_start, max(prefix) prefix_end, cast(sum(n) as bigint) n from (select prefix, n, cast((sum(n) over (order by prefix) - 1) * 8 // sum(n) over () as bigint) shard from (select ip >> 8 prefix, count(*) n from mem group by 1)) group by 1)"


def _plan(r: Run) -> DataFrame:
    return shard_plan(r)


@query("a11_subset_plan", f"select row_number() over (order by shard) - 1 shard, prefix_start, prefix_end, n from {_PLAN} where shard in (1, 3, 5)")
def _(r: Run):
    kept = _plan(r).where(F.col("shard").isin(1, 3, 5))  # one row a shard
    return kept.select((F.row_number().over(Window.orderBy("shard")) - 1).alias("shard"), "prefix_start", "prefix_end", "n")


@query("b13_computed_fields", "select ip, devices, reports, reports + devices activity, reports - mobile rest, round(reports / nullif(devices, 0), 6) per_device from mem")
def _(r: Run):
    c = F.col
    return r.members.select("ip", "devices", "reports", (c("reports") + c("devices")).alias("activity"), (c("reports") - c("mobile")).alias("rest"), F.round(S.ratio(c("reports"), c("devices")), 6).alias("per_device"))


@query("c4_exact_quantiles", "select tile - 1 shard, min(ip) ip_start, max(ip) ip_end, count(*) n from (select ip, ntile(8) over (order by ip) tile from mem) group by 1")
def _(r: Run):
    return ranks.tiles(r.members.select("ip"), 8, bits=16).groupBy("shard").agg(F.min("ip").alias("ip_start"), F.max("ip").alias("ip_end"), count())


_CHECKS = "count(*) = 8 all_shards, min(n) > 0 none_empty, bool_and(coalesce(prefix_start > before, true)) monotone, cast(sum(n) as bigint) >= 8 enough_rows"


@query("c7_plan_checks", f"select {_CHECKS} from (select *, lag(prefix_end) over (order by shard) before from {_PLAN})")
def _(r: Run):
    p = _plan(r).withColumn("before", F.lag("prefix_end").over(Window.orderBy("shard")))  # one row a shard
    return p.agg((F.count(F.lit(1)) == 8).alias("all_shards"), (F.min("n") > 0).alias("none_empty"), F.bool_and(F.coalesce(F.col("prefix_start") > F.col("before"), F.lit(True))).alias("monotone"), (F.sum("n") >= 8).alias("enough_rows"))


@query("k9_plan_ids", f"select min(shard) lo, max(shard) hi, count(distinct shard) ids, count(distinct shard) = max(shard) - min(shard) + 1 contiguous from {_PLAN}")
def _(r: Run):
    ids = F.countDistinct("shard")
    return _plan(r).agg(F.min("shard").alias("lo"), F.max("shard").alias("hi"), ids.alias("ids"), (ids == F.max("shard") - F.min("shard") + 1).alias("contiguous"))


@query("c9_balanced_buckets", "select block, cast(cum * ((everything + 499) // 500) // (everything + 1) + 1 as bigint) bucket from (select block, sum(member_cnt) over (partition by block >> 12 order by member_cnt desc, block rows unbounded preceding) cum, sum(member_cnt) over (partition by block >> 12) everything from pre)")
def _(r: Run):
    return ranks.balanced(r.pre.select("block", "member_cnt", F.shiftright("block", SHARD_BITS).alias("shard")), "member_cnt", "block", 500, "shard").select("block", "bucket")


_SHARES = {"wifi_share": ("wifi", "devices"), "vpn_share": ("vpn", "devices"), "wired_share": ("wired", "devices"), "worktime_share": ("worktime", "reports"), "weekend_share": ("weekend", "reports"), "late_night_share": ("late_night", "reports"), "holiday_share": ("weekend", "reports")}


@query("e12_block_ratios", "select final, " + ", ".join(f"round({a}_valid / nullif({b}_valid, 0), 6) {n}" for n, (a, b) in _SHARES.items()) + " from fin")
def _(r: Run):
    return r.final.select("final", *[F.round(S.ratio(F.col(f"{a}_valid"), F.col(f"{b}_valid")), 6).alias(n) for n, (a, b) in _SHARES.items()])


@query("h3_derived_columns", "select final, concat_ws('.', (ip_start >> 24) & 255, (ip_start >> 16) & 255, (ip_start >> 8) & 255, ip_start & 255) start_address, round(coalesce(devices_valid / nullif(valid_cnt, 0), 0), 4) devices_per_ip, round(coalesce(reports_valid / nullif(valid_cnt, 0), 0), 4) reports_per_ip, least(round(coalesce(reports_valid / nullif(devices_valid, 0), 0), 4), 99.9999) reports_per_device from hb")
def _(r: Run):
    per = lambda a, b: F.round(F.coalesce(S.ratio(F.col(a), F.col(b)), F.lit(0.0)), 4)
    return r.h_blocks.select(
        "final", S.dotted(F.col("ip_start")).alias("start_address"), per("devices_valid", "valid_cnt").alias("devices_per_ip"), per("reports_valid", "valid_cnt").alias("reports_per_ip"),
        F.least(per("reports_valid", "devices_valid"), F.lit(99.9999)).alias("reports_per_device"),
    )


@query("h7_compact_runs", "select run, count(*) ips, count(distinct atom27) atoms, cast(sum(devices) as bigint) devices, cast(sum(reports) as bigint) reports, cast(sum(mobile) as bigint) mobile, cast(sum(wifi) as bigint) wifi, count(distinct operator) operators, round(sum(devices) / count(*), 6) devices_per_ip from e group by 1")
def _(r: Run):
    sums = [F.sum(m).alias(m) for m in ("devices", "reports", "mobile", "wifi")]
    return r.e.groupBy("run").agg(count("ips"), F.countDistinct("atom27").alias("atoms"), *sums, F.countDistinct("operator").alias("operators"), F.round(S.ratio(F.sum("devices"), F.count(F.lit(1))), 6).alias("devices_per_ip"))


@query("h8_unstable", "select final, count(*) filter (low) unstable, round(count(*) filter (low) / count(*), 4) unstable_ratio, count(*) filter (not is_valid) abnormal, round(count(*) filter (not is_valid) / count(*), 4) abnormal_ratio from h join (select 16777216 + o_orderkey ip, o_orderpriority = '5-LOW' low from orders) using (ip) group by 1")
def _(r: Run):
    n, low, bad = F.count(F.lit(1)), F.count_if(F.col("stability") == "unstable"), F.count_if("is_abnormal")
    return r.h.groupBy("final").agg(low.alias("unstable"), F.round(S.ratio(low, n), 4).alias("unstable_ratio"), bad.alias("abnormal"), F.round(S.ratio(bad, n), 4).alias("abnormal_ratio"))


@query("i1_rule_filter", "select final from fin where valid_cnt >= 8 and (tier in ('small', 'medium') or reports_valid > 500)")
def _(r: Run):
    rule = {"all": [{"field": "valid_cnt", "op": ">=", "value": 8}, {"any": [{"field": "tier", "op": "in", "value": ["small", "medium"]}, {"field": "reports_valid", "op": ">", "value": 500}]}]}
    return r.final.where(rules.compile_rule(rule, r.final.columns)).select("final")


@query("i2_tiered_rule", "select final from fin where case when valid_cnt <= 16 then devices_valid >= 40 when valid_cnt <= 128 then devices_valid >= 500 else true end")
def _(r: Run):
    rule = {"field": "devices_valid", "op": ">=", "by": "valid_cnt", "bands": [(16, 40), (128, 500), (None, 0)]}
    return r.final.where(rules.compile_rule(rule, r.final.columns)).select("final")


@query("i3_failed_dimensions", "select final from fin where valid_cnt > 2 and (mobile_valid > 10)::int + (wifi_valid > 10)::int + (late_night_valid > 60)::int >= 2")
def _(r: Run):
    dims = [{"field": f, "op": ">", "value": v} for f, v in (("mobile_valid", 10), ("wifi_valid", 10), ("late_night_valid", 60))]
    rule = {"needs": [{"field": "valid_cnt", "op": ">", "value": 2}], "dims": dims, "failed": 2}
    return r.final.where(rules.compile_rule(rule, r.final.columns)).select("final")


_FUNNEL = ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(TAGS))


@query("i4_funnel", f""", tagged as (select *, {_TAG_SQL} tag from fin),
took as (select step, tag, count(t2.final) as rows, coalesce(cast(sum(member_cnt) as bigint), 0) member_cnt, coalesce(cast(sum(devices_valid) as bigint), 0) devices_valid from (values {_FUNNEL}) s(step, tag) left join (select tag tag2, * exclude (tag) from tagged) t2 on tag2 = s.tag group by 1, 2)
select step, tag, rows, member_cnt, devices_valid, (select count(*) from fin) - cast(sum(rows) over w as bigint) rows_left, cast((select sum(member_cnt) from fin) - sum(member_cnt) over w as bigint) member_cnt_left, cast((select sum(devices_valid) from fin) - sum(devices_valid) over w as bigint) devices_valid_left from took window w as (order by step)""")
def _(r: Run):
    return rules.funnel(r.final, TAGS, ["member_cnt", "devices_valid"])


@query("i5_tags", f"select final, {_TAG_SQL} tag from fin")
def _(r: Run):
    return rules.tag(r.final, TAGS).select("final", "tag")


_POOL = ["member_cnt", "valid_cnt", "reports_total", "devices_total", *[f"{m}_valid" for m in ("reports", "devices", "mobile", "wifi", "worktime", "workday", "weekend", "late_night")]]
_QUANTILES = {"p50": 0.5, "p85": 0.85, "p90": 0.9, "p95": 0.95}


@query("i6_pool_stats", " union all ".join(f"select '{m}' metric, " + ", ".join(f"round(quantile_cont({m}, {q}), 6) {n}" for n, q in _QUANTILES.items()) + f", round(avg({m}), 6) mean, cast(min({m}) as double) least, cast(max({m}) as double) most from (select *, {_TAG_SQL} tag from fin) where tag is null or tag = 'small'" for m in _POOL))
def _(r: Run):
    pool = rules.tag(r.final, TAGS[:-1]).where("tag is null")  # what the last tag gets to see
    long = pool.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in _POOL])).alias("x")).select("x.*")
    out = long.groupBy("metric").agg(F.round(F.avg("v"), 6).alias("mean"), F.min("v").cast("double").alias("least"), F.max("v").cast("double").alias("most"))
    q = ranks.percentiles(long, "metric", "v", _QUANTILES)
    return out.join(q.select("metric", *[F.round(n, 6).alias(n) for n in _QUANTILES]), "metric")


@query("i8_rule_pack", "select 'child' pack, count(*) n from fin where valid_cnt >= 4 and score <= 12 union all select 'parent', count(*) from fin where valid_cnt >= 4")
def _(r: Run):
    parent = [{"field": "valid_cnt", "op": ">=", "value": 4}]
    packs = {"parent": parent, "child": parent + [{"field": "score", "op": "<=", "value": 12}]}  # a pack inherits its parent's rules
    hits = [F.count_if(rules.compile_rule({"all": p}, r.final.columns)).alias(name) for name, p in packs.items()]
    return r.final.agg(*hits).select(F.explode(F.array(*[F.struct(F.lit(n).alias("pack"), F.col(n).alias("n")) for n in packs])).alias("x")).select("x.*")


@query("i10_reference_bands", "select case when 2 * devices_valid <= 7 * valid_cnt then 'low' when devices_valid <= 30 * valid_cnt then 'mid' else 'high' end band, 2 * mobile_valid > devices_valid mobile, count(*) n, round(quantile_cont(reports_valid, 0.05), 6) p05, round(quantile_cont(reports_valid, 0.5), 6) p50 from fin where valid_cnt > 0 group by 1, 2")
def _(r: Run):
    band = F.when(F.expr("2 * devices_valid <= 7 * valid_cnt"), "low").when(F.expr("devices_valid <= 30 * valid_cnt"), "mid").otherwise("high")
    blocks = r.final.where("valid_cnt > 0").select(F.struct(band.alias("band"), F.expr("2 * mobile_valid > devices_valid").alias("mobile")).alias("at"), "reports_valid")
    p = ranks.percentiles(blocks, "at", "reports_valid", {"p05": 0.05, "p50": 0.5})
    return blocks.groupBy("at").agg(count()).join(p, "at").select("at.*", "n", F.round("p05", 6).alias("p05"), F.round("p50", 6).alias("p50"))


@query("j4_histogram", "select bin, round(lo + (bin - 1) * (hi - lo) / 20, 6) left_edge, count(*) n from (select least(20, cast(floor((reports - lo) * 20 / (hi - lo)) as bigint) + 1) bin, lo, hi from mem, (select cast(min(reports) as double) lo, cast(max(reports) + 1 as double) hi from mem)) group by 1, 2")
def _(r: Run):
    edges = r.members.agg(F.min("reports").cast("double").alias("lo"), (F.max("reports") + F.lit(1.0)).alias("hi"))
    at = r.members.crossJoin(F.broadcast(edges))  # edges is one row
    bins = at.select("lo", "hi", F.least(F.lit(20), F.floor((F.col("reports") - F.col("lo")) * 20 / (F.col("hi") - F.col("lo"))) + 1).alias("bin"))
    return bins.groupBy("bin", F.expr("round(lo + (bin - 1) * (hi - lo) / 20, 6)").alias("left_edge")).agg(count())


_PICK = "md5(concat(cast({k} as varchar), 'seed'))"


def _pick(key: str):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit("seed")))


@query("j7_block_sample", f"select final, member_cnt, score from hb order by {_PICK.format(k='final')} limit 50")
def _(r: Run):
    return r.h_blocks.orderBy(_pick("final")).limit(50).select("final", "member_cnt", "score")


_FIVE = {"least": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "most": 1.0}


@query("j8_density_boxes", "select operator, " + ", ".join(f"round(quantile_cont(d, {q}), 6) {n}" for n, q in _FIVE.items()) + " from (select operator, final, sum(devices) filter (is_valid) / nullif(count(*) filter (is_valid), 0) d from fm group by 1, 2) group by 1")
def _(r: Run):
    own = r.final_members.groupBy("operator", "final").agg(S.ratio(F.sum(F.when(F.col("is_valid"), F.col("devices"))), F.count_if("is_valid")).alias("d"))
    return ranks.percentiles(own, "operator", "d", _FIVE, scale=1 << 20).select("operator", *[F.round(n, 6).alias(n) for n in _FIVE])


@query("j18_suspicious_cuts", "select block, cut_ip, least(l_cnt, r_cnt) fewest, abs(cv_l - cv_r) < 0.02 is not null and abs(cv_l - cv_r) < 0.02 even from ev where (trigger_report or trigger_mobile or trigger_operator or trigger_density or trigger_void) and (least(l_cnt, r_cnt) <= 5 or abs(cv_l - cv_r) < 0.02) order by fewest, cut_ip limit 100")
def _(r: Run):
    even = F.coalesce(F.abs(F.col("cv_l") - F.col("cv_r")) < 0.02, F.lit(False))
    out = r.events.where("is_cut").select("block", "cut_ip", F.least("l_cnt", "r_cnt").alias("fewest"), even.alias("even"))
    return out.where("fewest <= 5 or even").orderBy("fewest", "cut_ip").limit(100)


@query("j19_zone_samples", f"select zone, final from (select *, row_number() over (partition by zone order by {_PICK.format(k='final')}) rn from (select final, case when score between 18 and 22 then 'boundary' when count(*) over (partition by block) > 1 then 'split' else 'other' end zone from fin)) where rn <= 20")
def _(r: Run):
    parts = F.count(F.lit(1)).over(Window.partitionBy("block"))
    zone = r.final.select("final", F.when(F.col("score").between(18, 22), "boundary").when(parts > 1, "split").otherwise("other").alias("zone"))
    return zone.withColumn("rn", F.row_number().over(Window.partitionBy("zone").orderBy(_pick("final")))).where("rn <= 20").select("zone", "final")


@query("j22_library_rows", "select lib, count(*) ips, count(distinct operator) operators, cast(sum(devices) as bigint) devices, cast(sum(reports) as bigint) reports, round(sum(mobile) / nullif(sum(devices), 0), 6) mobile_share, round(count(*) filter (not is_valid) / count(*), 6) abnormal_share from lab where lib <> 'D' group by 1")
def _(r: Run):
    n, s = F.count(F.lit(1)), F.sum
    return r.labelled.where("lib <> 'D'").groupBy("lib").agg(n.alias("ips"), F.countDistinct("operator").alias("operators"), s("devices").alias("devices"), s("reports").alias("reports"), F.round(S.ratio(s("mobile"), s("devices")), 6).alias("mobile_share"), F.round(S.ratio(F.count_if(~F.col("is_valid")), n), 6).alias("abnormal_share"))


def matching(df: DataFrame, key: str, least: dict | None = None, most: dict | None = None, text: tuple[str, str] | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Rows of a summary within bounds, with a text filter, and without the keys of `exclude`."""
    for c, v in (least or {}).items():
        df = df.where(F.col(c) >= v)
    for c, v in (most or {}).items():
        df = df.where(F.col(c) <= v)
    if text:
        df = df.where(F.contains(F.lower(text[0]), F.lit(text[1].lower())))
    if exclude is not None:
        df = df.join(exclude.select(key), key, "left_anti")
    return df


def listing(df: DataFrame, sort: str, key: str, allowed: list[str], *filters, offset: int = 0, limit: int = 50) -> DataFrame:
    """A page of the matching rows of a summary, in descending order with nulls last and ties by key."""
    if sort not in allowed:
        raise ValueError(f"can't sort by {sort!r}")
    return matching(df, key, *filters).orderBy(F.desc_nulls_last(sort), key).offset(offset).limit(limit)


@query("j23_listing", "select final, tier, member_cnt, score from fin where member_cnt >= 3 and member_cnt <= 400 and contains(tier, 'm') and not (mobile_valid > 20 and valid_cnt >= 4) order by score desc nulls last, final limit 40 offset 20")
def _(r: Run):
    return listing(r.final.select("final", "tier", "member_cnt", "score"), "score", "final", ["score", "member_cnt"], {"member_cnt": 3}, {"member_cnt": 400}, ("tier", "M"), r.final.where("mobile_valid > 20 and valid_cnt >= 4"), offset=20, limit=40)


@query("j24_neighbours", ", rk as (select ip, row_number() over (order by ip) rn from mem) select t.ip target, cast(n.rn - t.rn as bigint) distance, n.ip, lib from rk t join rk n on n.rn between t.rn - 3 and t.rn + 3 and n.rn <> t.rn join lab l on l.ip = n.ip where t.ip in (select cut_ip from cuts)")
def _(r: Run):
    near = ranks.neighbours(r.members, r.events.where("is_cut").select(F.col("cut_ip").alias("ip")), 3, bits=12)
    return near.join(r.labelled.select("ip", "lib"), "ip").select("target", F.col("distance").cast("long").alias("distance"), "ip", "lib")


def traced(r: Run) -> DataFrame:
    """(ip, block, final, lib) of every member; the parts of a run are taken apart, so members aren't joined again."""
    dropped = r.blocked.join(r.pre.where("not keep_flag").select("block"), "block", "left_semi").withColumn("final", F.lit(None).cast("long"))
    parts = None
    for lib, df in (("H", r.h), ("E", r.e), ("F", r.f), ("D", dropped)):
        own = df.select("ip", "block", "final", F.lit(lib).alias("lib"))
        parts = own if parts is None else parts.unionByName(own)
    return parts


@query("j25_trace", "select m.ip, b.block, fm.final, lab.lib from mem m left join blk b using (ip) left join fm using (ip) left join lab using (ip)")
def _(r: Run):
    return traced(r)


@query("j27_shard_blocks", "select final, ip_start, ip_end, tier from fin where ip_start >> 12 = 4096 order by final limit 50 offset 10")
def _(r: Run):
    return r.final.where(F.shiftright("ip_start", SHARD_BITS) == 4096).orderBy("final").offset(10).limit(50).select("final", "ip_start", "ip_end", "tier")


@query("k1_step_metrics", "select 'source' step, ip >> 12 shard, 'members' metric, count(*) v from mem group by 2 union all select 'source', ip >> 12, 'valid', count(*) filter (is_valid) from mem group by 2 union all select 'source', -1, 'members', count(*) from mem union all select 'source', -1, 'valid', count(*) filter (is_valid) from mem union all select 'final', ip_start >> 12, 'blocks', count(*) from fin group by 2 union all select 'final', -1, 'blocks', count(*) from fin")
def _(r: Run):
    def both(df: DataFrame, step: str, key: str, **metrics) -> DataFrame:
        level = df.rollup(F.shiftright(key, SHARD_BITS).alias("shard")).agg(*[m.alias(n) for n, m in metrics.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("v")) for n in metrics])
        return level.select(F.lit(step).alias("step"), F.coalesce("shard", F.lit(-1)).alias("shard"), F.explode(pairs).alias("x")).select("step", "shard", "x.*")

    return both(r.members, "source", "ip", members=F.count(F.lit(1)), valid=F.count_if("is_valid")).unionByName(both(r.final, "final", "ip_start", blocks=F.count(F.lit(1))))


_STEPS = {"members": "mem", "final_members": "fm", "h": "h", "e": "e", "f": "f"}


def _coverage(r: Run) -> DataFrame:
    """(step, shard): which shards have rows at each step."""
    out = None
    for name in _STEPS:
        part = getattr(r, name).select(F.lit(name).alias("step"), F.shiftright("ip", SHARD_BITS).alias("shard")).distinct()
        out = part if out is None else out.unionByName(part)
    return out


_COVER = " union all ".join(f"select distinct '{s}' step, ip >> 12 shard from {t}" for s, t in _STEPS.items())
_MISSING = f"(select s.step, a.shard from (values {', '.join(f'({chr(39)}{s}{chr(39)})' for s in _STEPS)}) s(step), (select distinct ip >> 12 shard from mem) a where (s.step, a.shard) not in (select step, shard from ({_COVER})))"


def _missing(r: Run) -> DataFrame:
    steps = F.explode(F.array(*[F.lit(s) for s in _STEPS])).alias("step")
    every = r.members.select(F.shiftright("ip", SHARD_BITS).alias("shard")).distinct().select("shard", steps)
    return every.join(_coverage(r), ["step", "shard"], "left_anti")


@query("k10_incomplete_shards", f"select step, string_agg(cast(shard as varchar), ',' order by shard) shards from {_MISSING} group by 1")
def _(r: Run):
    # one entry a shard, and shards are a plan's few rows
    return _missing(r).groupBy("step").agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("shard")), lambda x: x.cast("string"))).alias("shards"))


@query("k16_run_diagnosis", f"select step, count(*) shards_with_rows, (select count(distinct ip >> 12) from mem) - count(*) missing from ({_COVER}) group by 1")
def run_diagnosis(r: Run):
    all_shards = r.members.agg(F.countDistinct(F.shiftright("ip", SHARD_BITS)).alias("every"))
    return _coverage(r).groupBy("step").agg(count("shards_with_rows")).crossJoin(F.broadcast(all_shards)).select("step", "shards_with_rows", (F.col("every") - F.col("shards_with_rows")).alias("missing"))


@query("j28_run_list", f"select step, count(*) = (select count(distinct ip >> 12) from mem) ready from ({_COVER}) group by 1")
def _(r: Run):
    return run_diagnosis(r).select("step", (F.col("missing") == 0).alias("ready"))


@query("j32_check_listing", "select 'h_e_overlap' name, (select count(*) from h where ip in (select ip from e)) = 0 passed, 'STOP' severity union all select 'h_f_overlap', (select count(*) from h where ip in (select ip from f)) = 0, 'STOP' union all select 'empty_sides', (select count(*) from ev where l_cnt = 0 or r_cnt = 0) = 0, 'WARN'")
def _(r: Run):
    check = lambda df, name, severity: df.agg((F.count(F.lit(1)) == 0).alias("passed")).select(F.lit(name).alias("name"), "passed", F.lit(severity).alias("severity"))
    own = r.h.select("ip")
    out = check(own.join(r.e.select("ip"), "ip", "left_semi"), "h_e_overlap", "STOP").unionByName(check(own.join(r.f.select("ip"), "ip", "left_semi"), "h_f_overlap", "STOP"))
    return out.unionByName(check(r.events.where("l_cnt = 0 or r_cnt = 0"), "empty_sides", "WARN"))


@query("k12_mainline_row", "select (select count(*) from fm) kept, (select count(*) from h) h, (select count(*) from r1) r1, (select count(*) from e) e, (select count(*) from f) f, (select count(*) from fm) = (select count(*) from h) + (select count(*) from r1) keep_equal, (select count(*) from r1) = (select count(*) from e) + (select count(*) from f) r1_equal, (select count(*) from e where run in (select run from rn where short_run)) short_leaks")
def mainline_row(r: Run):
    short = r.runs[1].where("short_run").select("run")
    parts = {"kept": r.final_members, "h": r.h, "r1": r.r1, "e": r.e, "f": r.f, "short_leaks": r.e.join(short, "run", "left_semi")}
    rows = None
    for name, df in parts.items():
        one = df.agg(count()).select(F.lit(name).alias("part"), "n")
        rows = one if rows is None else rows.unionByName(one)
    c = F.col
    out = rows.agg(*[F.max(F.when(c("part") == p, c("n"))).alias(p) for p in parts])
    return out.withColumns({"keep_equal": c("kept") == c("h") + c("r1"), "r1_equal": c("r1") == c("e") + c("f")})


@query("k13_summary_coverage", "select 'H' lib, (select count(*) from hb) blocks, (select count(distinct final) from h) summaries union all select 'E', (select count(*) from rn where not short_run), (select count(distinct run) from e) union all select 'F', (select count(*) from f), (select count(distinct ip) from f)")
def _(r: Run):
    def side(lib: str, have: DataFrame, made: DataFrame, key: str) -> DataFrame:
        both = have.select(key, F.lit(1).alias("a")).join(made.select(key).distinct().withColumn("b", F.lit(1)), key, "full")
        return both.agg(F.count("a").alias("blocks"), F.count("b").alias("summaries")).select(F.lit(lib).alias("lib"), "blocks", "summaries")

    out = side("H", r.h_blocks, r.h, "final").unionByName(side("E", r.runs[1].where("not short_run"), r.e, "run"))
    return out.unionByName(side("F", r.f, r.f, "ip"))


@query("k14_repair_scope", "select distinct atom27 from atm join (select distinct a.atom27 + d near from (select ip // 32 atom27 from fm where final in (select final from fin where valid_cnt between 1 and 3)) a, (select unnest([-2, -1, 0, 1, 2]) d)) on near = atom27")
def repair_scope(r: Run):
    failing = r.final_members.join(r.final.where("valid_cnt between 1 and 3").select("final"), "final", "left_semi").select("atom27").distinct()
    near = failing.select("atom27", F.explode(F.array(*[F.lit(d) for d in range(-2, 3)])).alias("d")).select((F.col("atom27") + F.col("d")).alias("atom27"))
    return r.atoms.join(near.distinct(), "atom27", "left_semi").select("atom27")


@query("k15_partial_rebuild", "select 'first' run_id, cast(atom27 // 128 as int) shard_id, atom27, valid_cnt from atm")
def _(r: Run):
    path = f"{shared_dir(r.spark)}/sink-{uuid.uuid4().hex}"
    rows, stale = _atoms_of(r, "first"), F.col("shard_id") % 3 == 0
    state.replace_shards(rows.withColumn("valid_cnt", F.when(stale, F.lit(-1)).otherwise(F.col("valid_cnt"))), path)
    state.replace_shards(rows.where(stale), path)  # only the stale shards are computed and written again
    return r.spark.read.parquet(path).select(F.col("run_id").cast("string").alias("run_id"), F.col("shard_id").cast("int").alias("shard_id"), "atom27", "valid_cnt")


def c6_rebalanced_plan(spark, sf_dir: str) -> DataFrame:
    """Eight equal spans of the members' addresses after boundary moves. SQL can't express the loop; a test holds it against a plain one."""
    members = run_of(spark, sf_dir).members
    lo, hi = members.agg(F.min("ip"), F.max("ip")).first()
    step = (hi - lo) // 8 + 1
    bounds, counts = ranks.rebalanced(members, [lo + i * step for i in range(8)] + [hi + 1])
    return spark.createDataFrame([(i, bounds[i], bounds[i + 1], counts[i]) for i in range(8)], "shard int, ip_start long, ip_end long, n long")


QUERIES["c6_rebalanced_plan"] = c6_rebalanced_plan
