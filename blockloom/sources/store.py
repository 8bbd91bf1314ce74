"""A folder of tables by run and shard: written whole or in part, and read by run."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from blockloom.sources import runs as state
from blockloom.sources.stage import stage

#: Fixed: the columns without which a summary row isn't ready, by table.
REQUIRED = {"h_summary": ["start_address", "avg_apps_per_ip"], "e_summary": ["start_address"], "f_summary": ["address", "reports", "devices"]}


#: A run's shards lie in at most about this many folders, so that a write's files don't grow with the address space.
FOLDERS = 256


class Store:
    """Tables under `path`, each with partitions run_id and shard_id. Its schema is kept beside it, so a table may be empty.

    A folder holds one shard, or 2^fold of them where lay_out() has said so for a run; rows carry their own shard.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folds: dict[str, int] = {}

    def _folder(self, *parts: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _exists(self, *parts: str) -> bool:
        system, folder = self._folder(*parts)
        return system.exists(folder)

    def lay_out(self, run_id: str, least: int, most: int, folders: int = FOLDERS) -> None:
        """Deal a run's shards least to most to at most folders + 1 folders; before its first write."""
        fold = 0
        while (most - least) >> fold >= folders:
            fold += 1
        if fold:
            state.write_config(self.spark, f"{self.path}/layout", run_id, {"fold": fold})
        self._folds[run_id] = fold

    def fold(self, run_id: str) -> int:
        if run_id not in self._folds:
            found = []
            if self._exists("layout", f"run_id={run_id}"):
                found = self.spark.read.schema("key string, value string, run_id string").parquet(f"{self.path}/layout").where((F.col("run_id") == run_id) & (F.col("key") == "fold")).collect()  # one row
            self._folds[run_id] = int(found[0].value) if found else 0
        return self._folds[run_id]

    def listed(self, shards: list[int]) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame([(s,) for s in shards], "shard_id int"))

    def write(self, table: str, df: DataFrame, run_id: str, shard: Column) -> None:
        """Replace the shards of the run that df has rows of; others stay as they are."""
        self._put(table, df, run_id, shard, [])

    def replace(self, table: str, df: DataFrame, run_id: str, shard: Column, shards: list[int]) -> None:
        """Make df's rows the rows of these shards, also where it has none. df mustn't read this table: stage it first."""
        self._put(table, df, run_id, shard, shards)

    def _put(self, table: str, df: DataFrame, run_id: str, shard: Column, shards: list[int]) -> None:
        df.limit(0).write.mode("ignore").parquet(f"{self.path}/schemas/{table}")
        fold, run = self.fold(run_id), f"run_id={run_id}"
        rows, wanted = df.withColumn("_shard", shard.cast("int")), set(shards)
        if shards or (fold and self._exists(table, run)):
            own = {r[0] for r in rows.select("_shard").distinct().collect()}  # one row a shard
            wanted |= own
            if fold and self._exists(table, run):
                # other shards of the same folders are written again
                beside = self.read(table, run_id, sorted({x for s in wanted for x in range(s >> fold << fold, (s >> fold) + 1 << fold)} - wanted))
                beside = stage(beside.drop("run_id").withColumnRenamed("shard_id", "_shard").select(*rows.columns), f"beside-{table}")
                rows = rows.unionByName(beside)
                own |= {r[0] for r in beside.select("_shard").distinct().collect()}
            left = {s >> fold for s in wanted} - {s >> fold for s in own}
        else:
            left = set()
        state.replace_shards(rows.withColumns({"run_id": F.lit(run_id), "shard_id": F.shiftright("_shard", fold)}), f"{self.path}/{table}")
        for s in sorted(left):
            system, folder = self._folder(table, run, f"shard_id={s}")
            system.delete(folder, True)

    def read(self, table: str, run_id: str | None = None, shards: list[int] | None = None) -> DataFrame:
        """The table's rows, of one run and of some of its shards where asked; only their folders are listed in the scan."""
        schema = self.spark.read.parquet(f"{self.path}/schemas/{table}").schema
        fields = [*schema.fields, StructField("run_id", StringType()), StructField("shard_id", IntegerType())]
        if not self._exists(table):
            return self.spark.createDataFrame([], StructType(fields))
        out = self.spark.read.schema(StructType([*schema.fields, StructField("_shard", IntegerType()), *fields[-2:]])).parquet(f"{self.path}/{table}")
        if run_id is not None:
            out = out.where(F.col("run_id") == run_id)
        if shards is not None:
            fold = self.fold(run_id)
            out = out.where(F.col("shard_id").isin(sorted({s >> fold for s in shards})))
            if fold:
                out = out.join(self.listed(shards).withColumnRenamed("shard_id", "_shard"), "_shard", "left_semi")
        return out.select(*schema.names, "run_id", F.col("_shard").alias("shard_id"))

    # runs

    def register(self, run_id: str, created: datetime.datetime) -> None:
        """Enter a run, or enter it again."""
        one = self.spark.createDataFrame([(run_id, created)], "run string, created_at timestamp")
        self.write("runs", one.drop("run"), run_id, F.lit(0))

    def runs(self) -> DataFrame:
        """(run_id, created_at)."""
        return self.read("runs").select("run_id", "created_at")

    def resolve(self, run_id: str | None = None) -> str | None:
        """A run's id: the given one, or of none or `latest` the run created last; null without runs."""
        if run_id not in (None, "latest"):
            return run_id
        return state.latest_run(self.runs()).first()[0]

    def _states(self, table: str) -> DataFrame:
        """(run_id, created_at, lib, total, ready, state) for each run, of one summary."""
        made = self.read(table) if self._exists("schemas", table) else self.spark.createDataFrame([], "run_id string, " + ", ".join(f"{c} string" for c in REQUIRED[table]))
        found = state.readiness(made, REQUIRED[table], self.runs())
        return self.runs().join(found, "run_id").select("run_id", "created_at", F.lit(table[0]).alias("lib"), F.col("rows").alias("total"), F.col("complete").alias("ready"), "state")

    def summary_states(self) -> DataFrame:
        """(run_id, created_at, lib, total, ready, state, fallback): for a run whose summary isn't ready, the newest run whose is."""
        out = None
        for table in REQUIRED:
            out = self._states(table) if out is None else out.unionByName(self._states(table))
        best = out.where("state = 'ready'").groupBy("lib").agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("newest"))
        return out.join(best, "lib", "left").select("run_id", "created_at", "lib", "total", "ready", "state", F.when(F.col("state") != "ready", F.col("newest")).alias("fallback"))

    def run_list(self) -> DataFrame:
        """A row for each run, with its summaries' rows and readiness, its checks, and whether it is fit to be shown."""
        pick = lambda lib, c: F.max(F.when(F.col("lib") == lib, F.col(c)))
        aggs = [x for lib in "hef" for x in (pick(lib, "total").alias(f"{lib}_rows"), F.coalesce(pick(lib, "state") == "ready", F.lit(False)).alias(f"{lib}_ready"))]
        each = self.summary_states().groupBy("run_id", "created_at").agg(*aggs)
        if self._exists("schemas", "checks"):
            qa = self.read("checks").groupBy("run_id").agg(F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("checks_passed"))
        else:
            qa = self.spark.createDataFrame([], "run_id string, checks long, checks_passed long")
        out = each.join(qa, "run_id", "left").fillna(0, ["checks", "checks_passed"])
        passed = (F.col("checks") > 0) & (F.col("checks") == F.col("checks_passed"))
        whole = F.col("h_ready") & F.col("e_ready") & F.col("f_ready")
        return out.withColumns({"all_passed": passed, "bundle_ready": whole, "preferred": whole & passed})
