"""Queries that complete the research listings, the what-if comparisons and the run diagnosis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.operators import ranks
from blockloom.operators import segments as S
from blockloom.plans import research
from blockloom.plans.further import QUERIES, SQL, count
from blockloom.plans.queries import query
from blockloom.plans.research import SHARD_BITS
from blockloom.plans.run import Config, Run
from blockloom.sources.fixture import MEASURES

__all__ = ["QUERIES", "SQL"]

_KEYS = ["ip", "country", "operator"]


def _field_sql(part: str, table: str, fields: list[str]) -> str:
    distinct = lambda f: f"count(distinct {f})" if f in _KEYS else "null::bigint"
    return " union all ".join(f"select '{part}' part, '{f}' field, count(*) n, count(*) filter ({f} is null) nulls, {distinct(f)} distinct_values from {table}" for f in fields)


def _fields(df: DataFrame, part: str, fields: list[str]) -> DataFrame:
    """(part, field, n, nulls, distinct_values), one pass; values are only counted for keys."""
    each = [x for f in fields for x in (F.count_if(F.col(f).isNull()).alias(f"{f}_nulls"), (F.countDistinct(f) if f in _KEYS else F.lit(None).cast("long")).alias(f"{f}_values"))]
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_nulls").alias("nulls"), F.col(f"{f}_values").alias("distinct_values")) for f in fields]))
    return df.agg(count(), *each).select(F.lit(part).alias("part"), "n", long.alias("x")).select("part", "n", "x.*")


@query("a6_fields", _field_sql("source", "src", [*_KEYS, *MEASURES]) + " union all " + _field_sql("abnormal", "(select ip from src where not is_valid)", ["ip"]))
def _(r: Run):
    return _fields(r.source, "source", [*_KEYS, *MEASURES]).unionByName(_fields(r.abnormal, "abnormal", ["ip"]))


def renumbered(e: DataFrame, bound: int = 16_384) -> DataFrame:
    """(run_no, run, ip_start, ip_end, members): runs of more than `bound` members cut by /16 and then by count, numbered by start."""
    large = e.groupBy("run").agg((F.count(F.lit(1)) > bound).alias("large"))
    at = e.join(large, "run").withColumn("p16", F.when(F.col("large"), F.shiftright("ip", 16)))
    piece = F.row_number().over(Window.partitionBy("run", "p16").orderBy("ip")) - 1  # 65,536 rows at most where a run is large
    pieces = at.withColumn("piece", F.floor(piece / bound)).groupBy("run", "p16", "piece").agg(F.min("ip").alias("ip_start"), F.max("ip").alias("ip_end"), count("members"))
    return ranks.ranked(pieces, "ip_start", out="run_no").select("run_no", "run", "ip_start", "ip_end", "members")


@query("d7_renumbered_runs", "select row_number() over (order by ip_start) run_no, * from (select run, min(ip) ip_start, max(ip) ip_end, count(*) members from (select run, ip, p16, (row_number() over (partition by run, p16 order by ip) - 1) // 128 piece from (select run, ip, case when count(*) over (partition by run) > 128 then ip >> 16 end p16 from e)) group by run, p16, piece)")
def _(r: Run):
    return renumbered(r.e, 128)


@query("d8_gap_merge", "select block, max(ip) ip_end, count(*) member_cnt from (select ip, max(case when first then ip end) over (order by ip) block from (select ip, coalesce(ip - lag(ip) over (order by ip) > 3, true) as first from mem)) group by 1")
def _(r: Run):
    merged = S.islands(r.members.select("ip"), "ip", r.config.chunk_bits, max_gap=2, out="block")
    return merged.groupBy("block").agg(F.max("ip").alias("ip_end"), count("member_cnt"))


_FUNNEL = {"members": "mem", "kept": "kept", "h": "h", "r1": "r1", "e": "e", "f": "f"}


@query("j3_funnel", " union all ".join(f"select '{s}' step, count(*) n, round(count(*) / (select count(*) from mem), 6) share from {t}" for s, t in _FUNNEL.items()))
def _(r: Run):
    # one row a step
    rows = reduce(DataFrame.unionByName, [getattr(r, s).agg(count()).select(F.lit(s).alias("step"), "n") for s in _FUNNEL])
    return rows.select("step", "n", F.round(F.col("n") / F.max(F.when(F.col("step") == "members", F.col("n"))).over(Window.partitionBy()), 6).alias("share"))


def histogram(df: DataFrame, field: str, bins: int) -> DataFrame:
    """(bin, left_edge, n) of equal widths from the least value to the greatest plus 0.001; nulls are left out."""
    known = df.where(F.col(field).isNotNull()).select(F.col(field).cast("double").alias("v"))
    edges = known.agg(F.min("v").alias("lo"), (F.max("v") + F.lit(0.001)).alias("hi"))
    at = known.crossJoin(F.broadcast(edges)).withColumn("bin", F.least(F.lit(bins), F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))) + 1))  # edges is one row
    return at.groupBy("bin", F.round(F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins, 6).alias("left_edge")).agg(count())


@query("j4_block_histogram", "select bin, round(lo + (bin - 1) * (hi - lo) / 30, 6) left_edge, count(*) n from (select least(30, cast(floor((v - lo) * 30 / (hi - lo)) as bigint) + 1) bin, lo, hi from (select cast(devices_valid as double) v from fin), (select cast(min(devices_valid) as double) lo, cast(max(devices_valid) as double) + 0.001::double hi from fin)) group by 1, 2")
def _(r: Run):
    return histogram(r.final, "devices_valid", 30)


@query("j5_discrete", "select 'density' field, round(valid_cnt / 32, 6) v, count(*) n from atm group by 2 union all select 'run_length', run_len::double, count(*) from rn group by 2")
def _(r: Run):
    density = r.atoms.groupBy(F.lit("density").alias("field"), F.round(F.col("valid_cnt") / 32, 6).alias("v")).agg(count())
    return density.unionByName(r.runs[1].groupBy(F.lit("run_length").alias("field"), F.col("run_len").cast("double").alias("v")).agg(count()))


@query("j13_bands", "select 'density' field, cast(devices_valid // valid_cnt as bigint) band, count(*) n from fin where valid_cnt > 0 and devices_valid between 28 * valid_cnt and 32 * valid_cnt group by 2 union all select 'score', score::bigint, count(*) from fin where score between 18 and 22 group by 2")
def _(r: Run):
    density = r.final.where("valid_cnt > 0 and devices_valid between 28 * valid_cnt and 32 * valid_cnt").groupBy(F.lit("density").alias("field"), F.expr("devices_valid div valid_cnt").alias("band")).agg(count())
    return density.unionByName(r.final.where("score between 18 and 22").groupBy(F.lit("score").alias("field"), F.col("score").cast("long").alias("band")).agg(count()))


@query("j13_mostly_abnormal", "select final, member_cnt, valid_cnt from fin where member_cnt >= 100 and 2 * valid_cnt < member_cnt order by member_cnt desc, final limit 10")
def _(r: Run):
    return r.final.where("member_cnt >= 100 and 2 * valid_cnt < member_cnt").orderBy(F.desc("member_cnt"), "final").limit(10).select("final", "member_cnt", "valid_cnt")


@query("j14_edge_atoms", "select valid_cnt, count(*) atoms, count(*) filter (run is not null and not short_run) in_e from atm left join (select atom27, run, short_run from ps join rn using (run)) using (atom27) where valid_cnt between 5 and 9 group by 1")
def _(r: Run):
    passing, runs = r.runs
    long = passing.join(runs.where("not short_run").select("run"), "run", "left_semi").select("atom27", F.lit(True).alias("in_run"))
    return r.atoms.where("valid_cnt between 5 and 9").join(long, "atom27", "left").groupBy("valid_cnt").agg(count("atoms"), F.count("in_run").alias("in_e"))


@query("j14_longest_runs", "select run, run_len, (select count(*) from e where e.run = rn.run) members from rn order by run_len desc, run limit 10")
def _(r: Run):
    longest = r.runs[1].orderBy(F.desc("run_len"), "run").limit(10).select("run", "run_len")
    sizes = r.e.join(F.broadcast(longest.select("run")), "run", "left_semi").groupBy("run").agg(count("members"))  # ten runs
    return longest.join(sizes, "run", "left").fillna(0, ["members"])


_CUT = "(trigger_report or trigger_mobile or trigger_operator or trigger_density or trigger_void)"


@query("j17_split_totals", f"select count(*) filter {_CUT.replace('(', '(where ', 1)} cuts, count(*) filter (where {_CUT} and least(l_cnt, r_cnt) <= 2) low_sample, round(avg(abs(cv_l - cv_r)) filter (where {_CUT}), 6) cv_gap, (select count(*) from hb where block in (select block from fin group by 1 having count(*) > 1)) h_from_split from ev")
def _(r: Run):
    split = r.final.groupBy("block").agg(count()).where("n > 1").select("block")
    from_split = r.h_blocks.join(split, "block", "left_semi").agg(count("h_from_split"))
    cuts = r.events.where("is_cut").agg(count("cuts"), F.count_if(F.least("l_cnt", "r_cnt") <= 2).alias("low_sample"), F.round(F.avg(F.abs(F.col("cv_l") - F.col("cv_r"))), 6).alias("cv_gap"))
    return cuts.crossJoin(from_split)  # one row each


_OTHER_CUTS = ((2, 1), (5, 1), (20, 1), (100, 1))
_AGAIN = "(select *, new_score - score moved, tier in ('medium', 'large', 'xlarge') and valid_cnt >= 4 and member_cnt >= 4 was_h, new_tier in ('medium', 'large', 'xlarge') and valid_cnt >= 4 and member_cnt >= 4 is_h from (select *, case when valid_cnt = 0 then 'invalid' when new_score >= 40 then 'xlarge' when new_score >= 30 then 'large' when new_score >= 20 then 'medium' when new_score >= 10 then 'small' else 'micro' end new_tier from (select *, wa + case when valid_cnt = 0 then null when devices_valid <= 2*valid_cnt then 1 when devices_valid <= 5*valid_cnt then 2 when devices_valid <= 20*valid_cnt then 4 when devices_valid <= 100*valid_cnt then 16 else 32 end new_score from fin)))"


def rescored(final: DataFrame, cuts: tuple, config: Config = Config()) -> DataFrame:
    """Final blocks scored with other density cuts: tier and score before and after, and whether a block is in H."""
    again = S.scored(final.withColumns({"was": F.col("tier"), "old": F.col("score")}), cuts)
    large = (F.col("valid_cnt") >= config.h_least_valid) & (F.col("member_cnt") >= config.h_least_members)
    inside = lambda tier: F.col(tier).isin(*config.h_tiers) & large
    return again.select("final", "member_cnt", F.col("was").alias("tier"), F.col("tier").alias("new_tier"), (F.col("score") - F.col("old")).alias("moved"), inside("was").alias("was_h"), inside("tier").alias("is_h"))


@query("j20_h_changes", f"select was_h, is_h, count(*) blocks, cast(sum(member_cnt) as bigint) members from {_AGAIN} group by 1, 2")
def _(r: Run):
    return rescored(r.final, _OTHER_CUTS, r.config).groupBy("was_h", "is_h").agg(count("blocks"), F.sum("member_cnt").alias("members"))


@query("j20_top_moves", f"select final, tier, new_tier, moved from {_AGAIN} where tier <> new_tier order by abs(moved) desc, member_cnt desc, final limit 20")
def _(r: Run):
    moved = rescored(r.final, _OTHER_CUTS, r.config).where("tier <> new_tier")
    return moved.orderBy(F.desc(F.abs("moved")), F.desc("member_cnt"), "final").limit(20).select("final", "tier", "new_tier", "moved")


_TRY = "select {v} least_valid, {l} least_run, count(*) members from r1 where atom27 in (select atom27 from (select atom27, count(*) over (partition by g) n from (select atom27, atom27 - row_number() over (order by atom27) g from atm where valid_cnt >= {v})) where n >= {l})"
_TRIES = ((7, 3), (5, 2), (9, 4))


@query("j21_whatif_members", " union all ".join(_TRY.format(v=v, l=n) for v, n in _TRIES))
def _(r: Run):
    def tried(v: int, least: int) -> DataFrame:
        passing, runs = S.runs(r.atoms.select("atom27", "valid_cnt", (F.col("valid_cnt") >= v).alias("is_e_atom")), least, r.config.chunk_bits)
        covered = passing.join(runs.where("not short_run").select("run"), "run", "left_semi").select("atom27")
        return r.r1.join(covered, "atom27", "left_semi").agg(F.lit(v).alias("least_valid"), F.lit(least).alias("least_run"), count("members"))

    return reduce(DataFrame.unionByName, [tried(v, n) for v, n in _TRIES])


@query("j23_listing_total", "select count(*) total, cast(ceil(count(*) / 40) as bigint) pages from fin where member_cnt between 3 and 400 and contains(tier, 'm') and not (mobile_valid > 20 and valid_cnt >= 4)")
def _(r: Run):
    found = research.matching(r.final, "final", {"member_cnt": 3}, {"member_cnt": 400}, ("tier", "M"), r.final.where("mobile_valid > 20 and valid_cnt >= 4"))
    return found.agg(count("total")).withColumn("pages", F.ceil(F.col("total") / 40))


@query("j24_neighbour_runs", ", rk as (select ip, row_number() over (order by ip) rn from mem) select t.ip target, cast(n.rn - t.rn as bigint) distance, n.ip, run from rk t join rk n on n.rn between t.rn - 2 and t.rn + 2 and n.rn <> t.rn left join e on e.ip = n.ip where t.ip in (select cut_ip from cuts)")
def _(r: Run):
    near = ranks.neighbours(r.members, r.events.where("is_cut").select(F.col("cut_ip").alias("ip")), 2)
    return near.join(r.e.select("ip", "run"), "ip", "left").select("target", F.col("distance").cast("long").alias("distance"), "ip", "run")


@query("j25_trace_keys", "select k.ip, block, final, lib from (select distinct o_custkey * 40 + 16777216 ip from orders) k left join (select b.ip, b.block, fm.final, lab.lib from blk b left join fm using (ip) join lab using (ip)) t on t.ip = k.ip")
def _(r: Run):
    keys = r.spark.read.parquet(f"{r.sf_dir}/orders.parquet").select((F.col("o_custkey") * 40 + 16777216).cast("long").alias("ip")).distinct()
    # keys that are no members stay, without a class; one sorted join, however many parts members come from
    return keys.join(research.traced(r).hint("merge"), "ip", "left")


@query("j30_phases", f"select shard, count(*) phases, string_agg(step, ',' order by step) steps from ({research._COVER}) group by 1")
def _(r: Run):
    return research._coverage(r).groupBy("shard").agg(count("phases"), F.concat_ws(",", F.sort_array(F.collect_list("step"))).alias("steps"))  # five steps at most


_STEPS = research._STEPS
_ALL = " union all ".join(f"select '{s}' step, ip >> 12 shard, is_valid from {t}" for s, t in _STEPS.items())


@query("k1_all_steps", f"select step, coalesce(shard, -1) shard, unnest(['members', 'valid']) metric, unnest([count(*), count(*) filter (is_valid)]) v from ({_ALL}) group by grouping sets ((step, shard), (step))")
def _(r: Run):
    every = reduce(DataFrame.unionByName, [getattr(r, s).select(F.lit(s).alias("step"), F.shiftright("ip", SHARD_BITS).alias("shard"), "is_valid") for s in _STEPS])
    own = every.groupBy("step", "shard").agg(count("members"), F.count_if("is_valid").alias("valid"))  # one row a step and shard
    both = own.unionByName(own.groupBy("step").agg(F.lit(-1).cast("long").alias("shard"), F.sum("members").alias("members"), F.sum("valid").alias("valid")))
    return both.select("step", "shard", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in ("members", "valid")])).alias("x")).select("step", "shard", "x.*")


@query("k14_run_scope", "select distinct run from ps join (select distinct a.atom27 + d near from (select ip // 32 atom27 from fm where final in (select final from fin where valid_cnt between 1 and 3)) a, (select unnest([-2, -1, 0, 1, 2]) d)) on near = atom27")
def _(r: Run):
    return r.runs[0].join(research.repair_scope(r), "atom27", "left_semi").select("run").distinct()


@query("k16_hot_shards", f"select shard, {', '.join(f'count(*) filter (step = {chr(39)}{s}{chr(39)}) {s}' for s in _STEPS)} from ({_ALL}) group by 1 order by members desc, shard limit 5")
def _(r: Run):
    every = reduce(DataFrame.unionByName, [getattr(r, s).select(F.lit(s).alias("step"), F.shiftright("ip", SHARD_BITS).alias("shard")) for s in _STEPS])
    return every.groupBy("shard").pivot("step", list(_STEPS)).agg(F.count(F.lit(1))).fillna(0).orderBy(F.desc("members"), "shard").limit(5)
