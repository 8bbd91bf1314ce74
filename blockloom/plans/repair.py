"""Stored runs, and their repair in part: what a change of H blocks reaches, and the rebuilding of these shards only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.operators import profiles
from blockloom.operators import segments as S
from blockloom.plans.run import Config, Run
from blockloom.sources.stage import stage
from blockloom.sources.store import Store

#: Keys of the stored tables: the column whose address names the shard, and the low bits that it lacks.
KEYS = {"h_blocks": ("ip_start", 0), "h": ("ip", 0), "r1": ("ip", 0), "atoms": ("atom27", 5), "passing": ("atom27", 5), "runs": ("run", 5), "e": ("ip", 0), "f": ("ip", 0), "h_summary": ("ip_start", 0), "e_summary": ("ip_start", 0), "f_summary": ("ip", 0)}


def shard_of(table: str, bits: int) -> Column:
    column, low = KEYS[table]
    return F.shiftright(column, bits - low)


def h_summary(h: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row a block: its range, tier and score, and the profile of its members."""
    about = blocks.select("final", "ip_start", "ip_end", "tier", "score", S.dotted(F.col("ip_start")).alias("start_address"))
    return about.join(profiles.profile(h, "final"), "final")


def e_summary(e: DataFrame, runs: DataFrame) -> DataFrame:
    """One row a run: its range, length and fill, and the profile of its members."""
    about = runs.where("not short_run").select("run", "run_len", "ip_start", "ip_end", S.dotted(F.col("ip_start")).alias("start_address"))
    return about.join(profiles.profile(e, "run"), "run").withColumn("fill_density", F.col("ip_count") / (32 * F.col("run_len")))


def f_summary(f: DataFrame) -> DataFrame:
    """One row an address, with ratios that are 0 where nothing is below."""
    over = lambda a, b: F.coalesce(F.round(S.ratio(F.col(a), F.col(b)), 4), F.lit(0.0))
    return f.select("ip", S.dotted(F.col("ip")).alias("address"), "operator", "reports", "devices", over("mobile", "devices").alias("mobile_ratio"), over("wifi", "devices").alias("wifi_ratio"), over("reports", "devices").alias("report_ratio"))


def lay_out(run: Run, store: Store, *run_ids: str) -> None:
    """Deal the shards of a run's address space to the store's folders."""
    span = run.members.agg(F.min("ip").alias("lo"), F.max("ip").alias("hi")).first()
    if span.lo is not None:
        for run_id in run_ids:
            store.lay_out(run_id, span.lo >> run.config.shard_bits, span.hi >> run.config.shard_bits)


def store_run(run: Run, store: Store, run_id: str) -> None:
    """Write the library tables and summaries of a run, each by its shard."""
    passing, runs = run.runs
    tables = {"h_blocks": run.h_blocks, "h": run.h, "r1": run.r1, "atoms": run.atoms, "passing": passing.select("atom27", "valid_cnt", "run"), "runs": runs, "e": run.e, "f": run.f}
    lay_out(run, store, run_id)
    tables |= {"h_summary": h_summary(run.h, run.h_blocks), "e_summary": e_summary(run.e, runs), "f_summary": f_summary(run.f)}
    for name, df in tables.items():
        store.write(name, df, run_id, shard_of(name, run.config.shard_bits))


@dataclass
class Scope:
    """What a repair reaches: `blocks` (final) that leave H, their `members` (ip, atom27, is_valid), the `atoms` whose run may
    change, the `runs` that they lie in now, and the shards of all these, the only ones to be rebuilt."""

    blocks: DataFrame
    members: DataFrame
    atoms: DataFrame
    runs: DataFrame
    shards: list[int]


def scope(store: Store, run_id: str, failing: Column, config: Config = Config(), reach: int = 2) -> Scope:
    """The reach of taking the failing H blocks of a stored run back to the residue.

    Their members' atoms change; an atom changes its run only through atoms that lead to it in steps of at most `reach`,
    each of them in a run before or after, or itself changed. So these chains are followed to their ends: they are the
    islands of such atoms, with gaps of reach - 1, that hold a changed atom. No rounds over shards are needed.
    """
    read = lambda t: store.read(t, run_id)
    blocks = stage(read("h_blocks").where(failing).select("final", "ip_start"), "failing")
    members = stage(read("h").join(blocks.select("final"), "final", "left_semi").select("ip", "atom27", "is_valid"), "failing-members")
    gain = members.groupBy("atom27").agg(F.count_if("is_valid").alias("gain"))
    new = gain.join(read("atoms").select("atom27", "valid_cnt"), "atom27", "left").where(F.coalesce("valid_cnt", F.lit(0)) + F.col("gain") >= config.e_atom_least)
    linked = read("passing").select("atom27").unionByName(new.select("atom27")).unionByName(gain.select("atom27")).distinct()
    chains = stage(S.islands(linked, "atom27", config.chunk_bits, max_gap=reach - 1, out="chain"), "chains")
    hit = chains.join(gain.select("atom27"), "atom27", "left_semi").select("chain").distinct()
    atoms = stage(chains.join(hit, "chain", "left_semi").select("atom27"), "dirty-atoms")
    runs = read("passing").join(atoms, "atom27", "left_semi").select("run").distinct()
    bits = config.shard_bits
    near = atoms.select(F.shiftright("atom27", bits - 5).alias("s")).unionByName(blocks.select(F.shiftright("ip_start", bits).alias("s")))
    return Scope(blocks, members, atoms, runs, sorted(r.s for r in near.distinct().collect()))  # one row a shard


def rebuild(store: Store, run_id: str, found: Scope, config: Config = Config()) -> None:
    """Recompute the tables and summaries of the scope's shards, and replace these partitions; no other file is touched.

    Runs that cross into other shards are unchanged there, as the scope holds whole chains; their atoms and members in
    those shards are read for lengths and summaries, not written.
    """
    shards, bits = found.shards, config.shard_bits
    if not shards:
        return
    inside = lambda t: store.read(t, run_id, shards).drop("run_id", "shard_id")
    outside = lambda t: store.read(t, run_id).join(store.listed(shards), "shard_id", "left_anti").drop("run_id", "shard_id")
    here = lambda df, t: df.withColumn("shard_id", shard_of(t, bits).cast("int")).join(store.listed(shards), "shard_id", "left_semi").drop("shard_id")
    gone = found.blocks.select("final")
    made = {"h_blocks": inside("h_blocks").join(gone, "final", "left_anti"), "h": inside("h").join(gone, "final", "left_anti")}
    made["r1"] = stage(inside("r1").unionByName(inside("h").join(gone, "final", "left_semi").select(*inside("r1").columns)), "rebuilt-r1")
    made["atoms"] = stage(S.atoms(made["r1"], config.e_atom_least), "rebuilt-atoms")
    crossing = inside("passing").select("run").distinct()
    halo = outside("passing").join(crossing, "run", "left_semi").select("atom27", "valid_cnt")
    every = made["atoms"].where("is_e_atom").select("atom27", "valid_cnt").unionByName(halo).withColumn("is_e_atom", F.lit(True))
    passing, runs = S.runs(every, config.e_run_least, config.chunk_bits)
    passing, runs = stage(passing.select("atom27", "valid_cnt", "run"), "rebuilt-passing"), stage(runs, "rebuilt-runs")
    made |= {"passing": here(passing, "passing"), "runs": here(runs, "runs")}
    covered = passing.join(runs.where("not short_run").select("run"), "run", "left_semi").select("atom27", "run")
    made["e"] = stage(made["r1"].join(covered, "atom27"), "rebuilt-e")
    made["f"] = stage(made["r1"].join(covered.select("atom27"), "atom27", "left_anti"), "rebuilt-f")
    own = made["runs"].where("not short_run").select("run")
    columns = made["e"].columns
    members = made["e"].unionByName(outside("e").select(*columns)).join(own, "run", "left_semi")
    made["h_summary"] = inside("h_summary").join(gone, "final", "left_anti")
    made["e_summary"] = e_summary(members, made["runs"])
    made["f_summary"] = f_summary(made["f"])
    ready = {t: stage(df.select(*inside(t).columns), f"rebuilt-{t}") for t, df in made.items()}  # all is read before anything is replaced
    for t, df in ready.items():
        store.replace(t, df, run_id, shard_of(t, bits), shards)
