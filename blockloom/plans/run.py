"""One run: every stage's DataFrame by name, built on demand; shared stages are written tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators import segments as S
from blockloom.sources import fixture
from blockloom.sources.stage import stage


@dataclass(frozen=True)
class Config:
    """Thresholds of a run."""

    countries: tuple[str, ...] = ("CN",)
    chunk_bits: int = 16
    nearest: int = 5  # members on either side of a boundary
    void_len: int = 3
    h_tiers: tuple[str, ...] = ("medium", "large", "xlarge")
    h_least_valid: int = 4
    h_least_members: int = 4
    e_atom_least: int = 7
    e_run_least: int = 3
    shard_bits: int = 12  # a shard of stored tables is the addresses with the same higher bits
    shards: int = 8  # of a range plan


class Run:
    """Stages over the members and the abnormal keys of any two tables; without them, over those made from sf_dir's tables.

    `members` needs ip (long, one row an address), country, operator and the measures; `abnormal` needs ip and may repeat it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, config: Config = Config(), members: DataFrame | None = None, abnormal: DataFrame | None = None):
        self.spark, self.sf_dir, self.config, self._source, self._abnormal = spark, sf_dir, config, members, abnormal

    @cached_property
    def source(self) -> DataFrame:
        return self._source if self._source is not None else fixture.source(self.spark, self.sf_dir)

    @cached_property
    def abnormal(self) -> DataFrame:
        return self._abnormal if self._abnormal is not None else fixture.abnormal(self.spark, self.sf_dir)

    @cached_property
    def members(self) -> DataFrame:
        return stage(S.members(self.source, self.abnormal, self.config.countries), "members")

    @cached_property
    def blocked(self) -> DataFrame:
        return stage(S.islands(self.members, "ip", self.config.chunk_bits, out="block"), "blocked")

    @cached_property
    def pre(self) -> DataFrame:
        return stage(S.scored(S.block_sums(self.blocked, "block")), "pre")

    @cached_property
    def kept(self) -> DataFrame:
        return self.blocked.join(self.pre.where("keep_flag").select("block"), "block", "left_semi")

    @cached_property
    def events(self) -> DataFrame:
        inside = self.blocked.join(S.candidates(self.pre).select("block"), "block", "left_semi")
        edges = stage(S.boundaries(inside, self.config.nearest), "edges")
        return stage(S.split_events(edges, self.config.void_len), "events")

    @cached_property
    def final_members(self) -> DataFrame:
        bits = self.config.chunk_bits
        cuts = self.events.where("is_cut").select("block", "cut_ip")
        # jumps are found on few columns; whole rows move once, for both kinds of pieces
        first = stage(S.cut_members(self.kept.select("block", "ip", "devices"), cuts, "block", "segment", bits), "segments")
        jumps = stage(S.inner_jumps(first, of=("block",)).select("block", "cut_ip"), "jumps")
        return stage(S.cut_each(self.kept, {"segment": cuts, "final": cuts.unionByName(jumps)}, "block", bits), "final-members")

    @cached_property
    def final(self) -> DataFrame:
        return stage(S.scored(S.block_sums(self.final_members, "final", F.min("block").alias("block"))), "final")

    @cached_property
    def h_blocks(self) -> DataFrame:
        c = self.config
        return self.final.where(F.col("tier").isin(*c.h_tiers) & (F.col("valid_cnt") >= c.h_least_valid) & (F.col("member_cnt") >= c.h_least_members))

    @cached_property
    def h(self) -> DataFrame:
        return self.final_members.join(self.h_blocks.select("final"), "final", "left_semi")

    @cached_property
    def r1(self) -> DataFrame:
        return self.final_members.join(self.h_blocks.select("final"), "final", "left_anti")

    @cached_property
    def atoms(self) -> DataFrame:
        return stage(S.atoms(self.r1, self.config.e_atom_least), "atoms")

    @cached_property
    def runs(self) -> tuple[DataFrame, DataFrame]:
        passing, runs = S.runs(self.atoms, self.config.e_run_least, self.config.chunk_bits)
        return stage(passing, "passing"), stage(runs, "runs")

    @cached_property
    def covered(self) -> DataFrame:
        """Atoms of E with their run; each has members in R1, so R1 without them is F."""
        passing, runs = self.runs
        return stage(passing.join(runs.where("not short_run").select("run"), "run").select("atom27", "run"), "covered")

    @cached_property
    def e(self) -> DataFrame:
        return self.r1.join(self.covered, "atom27")  # no table: a reader takes few of the columns

    @cached_property
    def f(self) -> DataFrame:
        return self.r1.join(self.covered.select("atom27"), "atom27", "left_anti")

    @cached_property
    def labelled(self) -> DataFrame:
        """Every member with its library: H, E, F or D (dropped). No table: a reader takes few of the columns."""
        columns = self.members.columns  # every part still has them, so members aren't joined again
        lib = lambda df, name: df.select(*columns, F.lit(name).alias("lib"))
        dropped = self.blocked.join(self.pre.where("not keep_flag").select("block"), "block", "left_semi")
        return lib(self.h, "H").unionByName(lib(self.e, "E")).unionByName(lib(self.f, "F")).unionByName(lib(dropped, "D"))


def run_pipeline(members: DataFrame, abnormal: DataFrame, config: Config = Config()) -> Run:
    """A run over one's own tables; its stages are made when asked for."""
    return Run(members.sparkSession, config=config, members=members, abnormal=abnormal)
