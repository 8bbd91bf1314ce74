"""Queries over the wide source: typed fields with rejects, wide summaries of blocks and runs; coverage of written summaries; the gate on planted faults."""

from __future__ import annotations

import re
from dataclasses import replace
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.operators import segments as S
from blockloom.operators import summaries
from blockloom.plans import further, repair
from blockloom.plans.queries import query
from blockloom.plans.run import Run
from blockloom.plans.stored import QUERIES, SQL, _store
from blockloom.sources import wide

__all__ = ["QUERIES", "SQL"]

#: The wide source over the given tables: an expression for each field, of members' columns, in words that Spark and DuckDB share but for DIV.
_MADE = {
    "ip_long": "ip", "ip_address": "'-'", "country": "'CN'", "operator": "operator", "reports_pre": "reports + ip % 5", "reports": "reports", "devices_pre": "devices + ip % 3", "devices": "devices", "apps": "reports DIV 3 + 1", "active_days": "ip % 14 + 1",
    "android_ids": "devices - devices DIV 4", "oaids": "devices DIV 2", "google_ids": "devices DIV 6", "boot_ids": "devices + mobile", "models": "reports % 40 + 1", "manufacturers": "reports % 9 + 1", "late_night_reports": "reports DIV 8", "worktime_reports": "reports DIV 3",
    "workday_reports": "reports - reports DIV 4", "weekend_reports": "reports DIV 4", "ethernet_reports": "reports DIV 11", "proxy_reports": "reports DIV 13", "root_reports": "reports DIV 17", "adb_reports": "reports DIV 19", "charging_reports": "reports DIV 2",
    "max_single_device_reports": "reports DIV 2 + ip % 7", "daa_reports": "reports DIV 2", "dna_reports": "reports DIV 20", "wifi_comparable_reports": "reports DIV 5", "ssids": "ip % 6", "bssids": "ip % 8", "gateway_reports": "reports DIV 6", "wifi_devices": "wifi", "mobile_devices": "mobile",
    "vpn_devices": "devices DIV 9", "empty_net_devices": "devices DIV 15", "abnormal_net_devices": "devices DIV 12", "wired_devices": "devices DIV 7", "maker_risk_state": "ip % 3", "stability": "case when ip % 10 = 0 then 'unstable' else 'stable' end",
}
#: Values that aren't numbers, and rows without a key.
_DIRTY = {"apps": ("ip % 101 = 0", "'n/a'"), "reports_pre": ("ip % 113 = 0", "null"), "oaids": ("ip % 127 = 0", "'12x'"), "ip_long": ("ip % 997 = 0", "''")}


def _text(name: str, div: str) -> str:
    made = f"cast({_MADE.get(name, 'null').replace('DIV', div)} as {'string' if div == 'div' else 'varchar'})"
    return f"case when {_DIRTY[name][0]} then {_DIRTY[name][1]} else {made} end" if name in _DIRTY else made


def source(r: Run) -> DataFrame:
    """The members as text under the source's names."""
    return r.members.select(*[F.expr(_text(name, "div")).alias(column) for name, column, _ in wide.FIELDS])


_KIND = {"L": "bigint", "D": "double", "S": "varchar", "I": "int"}
_WIDE = "wide as (select is_valid, ip real_ip, " + ", ".join(f"try_cast({_text(n, '//')} as {_KIND[k]}) {n}" for n, _, k in wide.FIELDS) + " from mem)"


@query("a1_wide_rejects", "select 'apps' field, count(*) n from mem where ip % 101 = 0 having count(*) > 0 union all select 'oaids', count(*) from mem where ip % 127 = 0 having count(*) > 0 union all select 'ip_long', count(*) from mem where ip % 997 = 0 having count(*) > 0 union all select 'row', count(*) from mem where ip % 997 = 0 having count(*) > 0")
def _(r: Run):
    return wide.rejects(wide.typed(source(r)))


def _long(name: str) -> str:
    return {v: k for k, v in wide.SHORTER.items()}.get(name, name)


def _share_sql(above: str, below: str, places: int, factor: int, most: float | None, empty: float | None) -> str:
    unit = 10**places
    exact = f"((2 * {above}::hugeint * {factor * unit} + {below}) // (2 * nullif({below}, 0)))::double / {unit}"
    return f"case when {below} > 0 then {f'least({exact}, {most})' if most is not None else exact} else {'null' if empty is None else f'{empty}::double'} end"


def _wide_sql(key: str, table: str, ratios: list[tuple], columns: list[str]) -> str:
    """The summary in SQL; the wide rows of a library's members."""
    zero = lambda f: f"coalesce({f}, 0)" if f in [*wide.SHORTER, "reports", "devices"] else f
    sums = ", ".join(f"coalesce(sum({zero(_long(c))}) filter (is_valid), 0)::bigint {n}" for n, c in summaries.SUMS.items())
    return f""", {_WIDE}, own as (select t.{key} k, w.* from {table} t join wide w on w.ip_long = t.ip),
tops as (select k, operator, row_number() over (partition by k order by count(*) desc, operator) place, count(*) over (partition by k) ops from own where is_valid and operator is not null and operator <> '' group by 1, 2),
s as (select k, count(*) filter (is_valid) ip_count, count(*) total_ip_count, count(*) filter (not is_valid) abnormal_ip_count, {sums}, max(max_single_device_reports) filter (is_valid) max_single_device_reports, sum(active_days) filter (is_valid)::bigint active_days_sum, count(active_days) filter (is_valid) active_days_count, count(*) filter (is_valid and stability = 'unstable') unstable_ip_count from own group by 1 having count(*) filter (is_valid) > 0)
select s.k {key}, {', '.join(f's.{c}' for c in columns)}, t.operator top_operator, coalesce(t.ops, 0) distinct_operators, {', '.join(f'{_share_sql(*rest)} {name}' for name, *rest in ratios)} from s left join tops t on t.k = s.k and t.place = 1"""


_COLUMNS = ["ip_count", *summaries.SUMS, "max_single_device_reports", "unstable_ip_count", "abnormal_ip_count"]


def _library(r: Run, part: DataFrame, key: str) -> DataFrame:
    """Members of a library with all fields of the wide source."""
    rows = wide.as_members(wide.typed(source(r)))
    return part.select("ip", key, "is_valid").join(rows, "ip")


@query("h3_wide_blocks", _wide_sql("final", "h", summaries.BOTH + summaries.BLOCK, _COLUMNS))
def _(r: Run):
    return summaries.wide(_library(r, r.h, "final"), "final", summaries.BOTH + summaries.BLOCK)


@query("h5_wide_runs", _wide_sql("run", "e", summaries.BOTH + summaries.RUN, _COLUMNS).replace("select s.k run,", "select s.k run, atom_end, run_len, short_run, s.k * 32 ip_start, atom_end * 32 + 31 ip_end, concat_ws('.', ((s.k * 32) >> 24) & 255, ((s.k * 32) >> 16) & 255, ((s.k * 32) >> 8) & 255, (s.k * 32) & 255) start_address, ((2 * ip_count::hugeint * 10000 + 32 * run_len) // (64 * run_len))::double / 10000 fill_density,").replace("from s left join tops", "from s join rn on rn.run = s.k left join tops"))
def _(r: Run):
    """Run geometry, fill, 32 sums and 21 ratios."""
    out = summaries.wide(_library(r, r.e, "run"), "run", summaries.BOTH + summaries.RUN).join(r.runs[1], "run").withColumn("room", 32 * F.col("run_len"))
    return out.withColumns({"start_address": S.dotted(F.col("ip_start")), "fill_density": summaries.share("ip_count", "room", 4)}).drop("room")


@query("h7_wide_compact", f", {_WIDE}, own as (select e.run, w.* from e join wide w on w.ip_long = e.ip), tops as (select run, operator, row_number() over (partition by run order by count(*) desc, operator) place from own where operator is not null and operator <> '' group by 1, 2) select run, count(*) ip_count, ((200 * sum(coalesce(devices, 0)) + count(*)) // (2 * count(*)))::double / 100 avg_devices, sum(coalesce(reports, 0))::bigint total_reports, sum(daa_reports)::bigint daa_reports, sum(dna_reports)::bigint dna_reports, ((200 * sum(manufacturers) + count(manufacturers)) // (2 * count(manufacturers)))::double / 100 avg_manufacturers, max(t.operator) top_operator from own left join tops t using (run) where t.place = 1 or t.place is null group by 1")
def _(r: Run):
    """The older summary of runs: all members count, abnormal ones too."""
    own = _library(r, r.e, "run")
    by = own.groupBy("run", "operator").agg(F.count(F.lit(1)).alias("c"), *[F.sum(x).alias(x) for x in ("devices", "reports", "daa_reports", "dna_reports", "manufacturers")], F.count("manufacturers").alias("m"))
    named = F.col("operator").isNotNull() & (F.col("operator") != "")
    out = by.groupBy("run").agg(F.sum("c").alias("ip_count"), *[F.sum(x).alias(x) for x in ("devices", "reports", "daa_reports", "dna_reports", "manufacturers", "m")], F.min(F.when(named, F.struct((-F.col("c")).alias("neg"), "operator"))).alias("top"))
    return out.select("run", "ip_count", summaries.share("devices", "ip_count", 2).alias("avg_devices"), F.col("reports").alias("total_reports"), "daa_reports", "dna_reports", summaries.share("manufacturers", "m", 2).alias("avg_manufacturers"), F.col("top.operator").alias("top_operator"))


# --- written summaries against what they are of

def coverage(store, run_id: str) -> DataFrame:
    """(lib, side, id): blocks, runs and addresses of a stored run without a summary row (missing), and rows of none (surplus)."""
    out = None
    for lib, table, made, key in (("H", "h_blocks", "h_summary", "final"), ("E", "runs", "e_summary", "run"), ("F", "f", "f_summary", "ip")):
        have = store.read(table, run_id)
        have = (have.where("not short_run") if lib == "E" else have).select(key, F.lit(True).alias("a"))
        both = have.join(store.read(made, run_id).select(key, F.lit(True).alias("b")).distinct(), key, "full").where("a is null or b is null")
        one = both.select(F.lit(lib).alias("lib"), F.when(F.col("b").isNull(), "missing").otherwise("surplus").alias("side"), F.col(key).alias("id"))
        out = one if out is None else out.unionByName(one)
    return out


def counts(store, run_id: str) -> DataFrame:
    """(lib, shard_id, entries, summaries, missing, surplus) of a stored run."""
    bits = repair.Config().shard_bits
    out = None
    for lib, table, made in (("H", "h_blocks", "h_summary"), ("E", "runs", "e_summary"), ("F", "f", "f_summary")):
        have = store.read(table, run_id)
        n = (have.where("not short_run") if lib == "E" else have).groupBy("shard_id").agg(F.count(F.lit(1)).alias("entries"))
        both = n.join(store.read(made, run_id).groupBy("shard_id").agg(F.count(F.lit(1)).alias("summaries")), "shard_id", "full").select(F.lit(lib).alias("lib"), "shard_id", "entries", "summaries")
        out = both if out is None else out.unionByName(both)
    shard = F.shiftright(F.col("id") * F.when(F.col("lib") == "E", 32).otherwise(1), bits).cast("int")
    gaps = coverage(store, run_id).groupBy("lib", shard.alias("shard_id")).agg(F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "surplus").alias("surplus"))
    return out.join(gaps, ["lib", "shard_id"], "full").fillna(0, ["entries", "summaries", "missing", "surplus"])


def planted(r: Run):
    """A stored run whose summaries lack every third block, every fifth run and every seventh address, and have rows of none."""
    store, bits = _store(r), r.config.shard_bits
    repair.store_run(r, store, "one")
    for table, keep, extra in (("h_summary", "final % 3 <> 0", "final % 4 = 1"), ("e_summary", "run % 5 <> 0", "run % 4 = 1"), ("f_summary", "ip % 7 <> 0", "ip % 31 = 1")):
        key = table[0] == "h" and "final" or table[0] == "e" and "run" or "ip"
        rows = store.read(table, "one").drop("run_id", "shard_id")
        move = {key: F.col(key) + (1 << 30)} | ({"ip_start": F.col("ip_start") + ((1 << 30) * (32 if table[0] == "e" else 1))} if table[0] in "he" else {})
        made = repair.stage(rows.where(keep).unionByName(rows.where(extra).withColumns(move)), f"planted-{table}")
        shards = [s.shard_id for s in store.read(table, "one").select("shard_id").distinct().collect()]  # one row a shard
        store.replace(table, made, "one", repair.shard_of(table, bits), shards)
    return store


_SETS = "(select 'H' lib, final id, final % 3 = 0 gone, final % 4 = 1 extra from hb union all select 'E', run, run % 5 = 0, run % 4 = 1 from rn where not short_run union all select 'F', ip, ip % 7 = 0, ip % 31 = 1 from f)"


@query("k13_planted_rows", f"select lib, 'missing' side, id from {_SETS} where gone union all select lib, 'surplus', id + 1073741824 from {_SETS} where extra")
def _(r: Run):
    return coverage(planted(r), "one")


@query("k13_planted_counts", f"select lib, (case when lib = 'E' then id * 32 else id end >> 12)::int shard_id, sum(case when new then 0 else 1 end)::bigint entries, sum(case when new or not gone then 1 else 0 end)::bigint summaries, sum(case when gone and not new then 1 else 0 end)::bigint missing, sum(case when new then 1 else 0 end)::bigint surplus from (select lib, id, gone, false new from {_SETS} union all select lib, id + 1073741824, false, true from {_SETS} where extra) group by 1, 2")
def _(r: Run):
    return counts(planted(r), "one")


# --- the gate on planted faults

def faulty(r: Run) -> SimpleNamespace:
    """The run's stages with a fault for each check: overlaps, lost and strange members, unmapped drops, unfit blocks, gaps."""
    columns = r.f.columns
    e_rows, ghosts = r.e.select(*columns), r.f.where("ip % 71 = 0").withColumn("ip", F.col("ip") + (1 << 33))
    unfit = r.pre.where("valid_cnt between 1 and 3").select(F.col("block").alias("final"), "tier", "valid_cnt").unionByName(r.pre.where("valid_cnt = 0").select(F.col("block").alias("final"), "tier", "valid_cnt"))
    return SimpleNamespace(
        spark=r.spark, config=replace(r.config, shards=5000), members=r.members, pre=r.pre, kept=r.kept, events=r.events, final_members=r.final_members,
        h=r.h.select(*columns).unionByName(e_rows.where("ip % 97 = 0")).unionByName(r.f.where("ip % 89 = 0")),
        e=e_rows.unionByName(r.f.where("ip % 83 = 0")).where("(ip >> 12) % 3 <> 0"), f=r.f.where("ip % 79 <> 0").unionByName(ghosts),
        h_blocks=r.h_blocks.select("final", "tier", "valid_cnt").unionByName(unfit), blocked=r.blocked.where(~((F.col("block") % 2 == 0) & F.col("is_abnormal"))),
    )


_FAULTY = """, hx as (select ip, atom27 from h union all select ip, atom27 from e where ip % 97 = 0 union all select ip, atom27 from f where ip % 89 = 0),
ex as (select * from (select ip, atom27 from e union all select ip, atom27 from f where ip % 83 = 0) where (ip >> 12) % 3 <> 0),
fx as (select ip, atom27 from f where ip % 79 <> 0 union all select ip + 8589934592, atom27 from f where ip % 71 = 0),
hbx as (select final, tier, valid_cnt from hb union all select block, tier, valid_cnt from pre where valid_cnt < 4), blkx as (select * from blk where not (block % 2 = 0 and not is_valid)),
parts as (select ip from hx union all select ip from ex union all select ip from fx)"""


def _on_faults(sql: str) -> str:
    for name in ("h", "e", "f", "hb", "blk"):
        sql = re.sub(rf"\bfrom {name}\b", f"from {name}x", sql)
    return sql.replace("* 8 //", "* 5000 //").replace("n <> 8 or m <> 7", "n <> 5000 or m <> 4999")


@query("k99_planted_gate", _FAULTY + " " + " union all ".join(f"select '{n}' name, '{'WARN' if n == 'empty_sides' else 'STOP'}' severity, ({_on_faults(q)}) failures, ({_on_faults(q)}) = 0 passed" for n, q in further._GATE.items()))
def _(r: Run):
    return further.checks(faulty(r))
