"""Members, consecutive blocks, scores, boundary windows, splitting, and the three libraries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockloom.operators import scans
from blockloom.sources.fixture import MEASURES
from blockloom.sources.stage import stage

K, BUCKET = 5, 64


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def wider(a: Column, b: Column) -> Column:
    """The larger of a/b and b/a; a null one is skipped."""
    return F.greatest(ratio(a, b), ratio(b, a))


def members(source: DataFrame, abnormal: DataFrame, countries: tuple[str, ...] = ("CN",)) -> DataFrame:
    """Rows of the countries, flagged by the distinct abnormal keys; prefix ids by integer division."""
    flags = abnormal.where("ip is not null").dropDuplicates(["ip"]).withColumn("is_abnormal", F.lit(True))
    kept = source.where(F.col("country").isin(*countries)).join(flags, "ip", "left").withColumn("is_abnormal", F.coalesce("is_abnormal", F.lit(False)))
    return kept.withColumns({"is_valid": ~F.col("is_abnormal"), "atom27": F.expr("ip div 32"), "bucket64": F.expr("ip div 64")})


def islands(df: DataFrame, key: str, chunk_bits: int = 16, max_gap: int = 0, out: str = "island") -> DataFrame:
    """Adds the first key of each run of consecutive keys (steps of at most max_gap + 1).

    Keys are cut into chunks by their high bits and runs are found within each chunk; what crosses chunk edges is settled
    on a frame of one row a chunk (2^16 at most for 32-bit keys and the default bits). No window sees all rows.
    """
    k = F.col(key)
    w = Window.partitionBy("__c").orderBy(key)
    d = df.withColumn("__c", F.shiftright(k, chunk_bits))
    d = d.withColumn("__new", F.coalesce(k - F.lag(key).over(w) > max_gap + 1, F.lit(True)))
    d = d.withColumn("__start", F.max(F.when(F.col("__new"), k)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    chunk = d.groupBy("__c").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.max("__start").alias("ls"))
    cw = Window.orderBy("__c")
    chunk = chunk.withColumn("touch", F.coalesce(F.col("lo") - F.lag("hi").over(cw) <= max_gap + 1, F.lit(False)))
    chunk = chunk.withColumn("brk", F.when(~(F.col("touch") & (F.col("ls") == F.col("lo"))), F.col("ls")))
    chunk = chunk.withColumn("carried", F.when(F.col("touch"), F.max("brk").over(cw.rowsBetween(Window.unboundedPreceding, -1))))
    fixed = d.join(chunk.select("__c", "lo", "carried"), "__c")
    return fixed.withColumn(out, F.when((F.col("__start") == F.col("lo")) & F.col("carried").isNotNull(), F.col("carried")).otherwise(F.col("__start"))).drop("__c", "__new", "__start", "lo", "carried")


def block_sums(df: DataFrame, by: str, *more: Column) -> DataFrame:
    """Counts and, for each measure, the total and the valid sum; `more` aggregates beside them."""
    sums = [F.coalesce(F.sum(x), F.lit(0)).alias(f"{m}_{s}") for m in MEASURES for s, x in (("total", F.col(m)), ("valid", F.when(F.col("is_valid"), F.col(m))))]
    return df.groupBy(by).agg(F.min("ip").alias("ip_start"), F.max("ip").alias("ip_end"), F.count(F.lit(1)).alias("member_cnt"), F.count_if("is_valid").alias("valid_cnt"), *sums, *more)


def scored(profile: DataFrame, density_cuts: tuple[tuple[int, int], ...] = ((7, 2), (13, 2), (30, 1), (200, 1))) -> DataFrame:
    """Densities, size and density weights, score and tier. Density cuts are fractions, compared by cross-multiplication."""
    v, d = F.col("valid_cnt"), F.col("devices_valid")
    wa = F.when(v <= 16, 1).when(v <= 48, 2).when(v <= 128, 4).when(v <= 512, 8).otherwise(16)
    (a, b), (e, f), (g, h), (i, j) = density_cuts
    wd = F.when(b * d <= a * v, 1).when(f * d <= e * v, 2).when(h * d <= g * v, 4).when(j * d <= i * v, 16).otherwise(32)
    out = profile.withColumns({"density": ratio(d, v), "report_density": ratio(F.col("reports_valid"), v), "wa": F.when(v > 0, wa), "wd": F.when(v > 0, wd)})
    s = F.col("score")
    tier = F.when(v == 0, "invalid").when(s >= 40, "xlarge").when(s >= 30, "large").when(s >= 20, "medium").when(s >= 10, "small").otherwise("micro")
    out = out.withColumn("score", F.col("wa") + F.col("wd")).withColumn("tier", tier)
    return out.withColumns({"keep_flag": v > 0, "drop_reason": F.when(v == 0, "ALL_ABNORMAL_BLOCK")})


def candidates(profile: DataFrame) -> DataFrame:
    """Kept blocks that span more than one bucket."""
    return profile.where(f"keep_flag and valid_cnt > 0 and ip_start div {BUCKET} <> ip_end div {BUCKET}")


def sides(df: DataFrame, k: int = K) -> DataFrame:
    """Per block and bucket: statistics of the first k (h_) and of the last k (t_) valid members; without valid ones counts are 0."""
    w = Window.partitionBy("block", "bucket64")
    v = df.withColumn("up", F.row_number().over(w.orderBy(F.desc("is_valid"), "ip"))).withColumn("down", F.row_number().over(w.orderBy(F.desc("is_valid"), F.desc("ip"))))
    aggs = []
    for p, rn in (("h_", "up"), ("t_", "down")):
        close = F.col("is_valid") & (F.col(rn) <= k)
        near = lambda c, close=close: F.when(close, F.col(c))
        aggs += [F.count_if(close).alias(f"{p}cnt"), F.sum(near("reports")).alias(f"{p}reports"), F.sum(near("mobile")).alias(f"{p}mobile"), F.sum(near("devices")).alias(f"{p}devices")]
        aggs += [F.avg(near("reports")).alias(f"{p}mr"), F.stddev_samp(near("reports")).alias(f"{p}sr"), F.avg(near("devices")).alias(f"{p}md"), F.stddev_samp(near("devices")).alias(f"{p}sd")]
        aggs += [F.when(F.min(near("operator")) == F.max(near("operator")), F.max(near("operator"))).alias(f"{p}op")]
    return v.groupBy("block", "bucket64").agg(*aggs)


def boundaries(df: DataFrame, k: int = K) -> DataFrame:
    """A row for each boundary between adjacent buckets of a block, with the k nearest valid members' statistics on either side."""
    s = stage(sides(df, k), "sides")
    left = s.select("block", "bucket64", *[F.col(c).alias(f"l{c[1:]}") for c in s.columns if c.startswith("t_")])
    right = s.select("block", (F.col("bucket64") - 1).alias("bucket64"), *[F.col(c).alias(f"r{c[1:]}") for c in s.columns if c.startswith("h_")])
    return left.join(right, ["block", "bucket64"]).fillna(0, [f"{p}_{c}" for p in "lr" for c in ("cnt", "reports", "mobile")])


def split_events(edges: DataFrame, void_len: int = 3) -> DataFrame:
    """Each boundary with its four triggers, and the cuts at either end of a run of void_len or more empty right sides."""
    c = F.col
    both = (c("l_cnt") > 0) & (c("r_cnt") > 0)
    e = edges.withColumns({
        "cut_ip": (c("bucket64") + 1) * BUCKET, "ratio_report": F.when(both, wider(c("r_mr"), c("l_mr"))), "cv_l": ratio(c("l_sr"), c("l_mr")), "cv_r": ratio(c("r_sr"), c("r_mr")),
        "mobile_diff": F.when(both, F.abs(ratio(c("r_mobile"), c("r_devices")) - ratio(c("l_mobile"), c("l_devices")))), "mobile_ratio": F.when(both, wider(c("r_mobile"), c("l_mobile"))),
        "device_ratio": F.when(both, wider(c("r_md"), c("l_md"))), "dv_l": ratio(c("l_sd"), c("l_md")), "dv_r": ratio(c("r_sd"), c("r_md")),
    })
    sure = lambda x: F.coalesce(x, F.lit(False))
    zero = lambda x: F.coalesce(c(x), F.lit(0.0))
    e = e.withColumns({
        "trigger_report": sure((c("ratio_report") > 4) & (c("cv_l") < 1.1) & (c("cv_r") < 1.1)), "trigger_mobile": sure((c("mobile_diff") > 0.5) | (c("mobile_ratio") > 4)),
        "trigger_operator": sure(c("l_op") != c("r_op")), "trigger_density": sure((c("device_ratio") > 10) & (zero("dv_l") < 1.5) & (zero("dv_r") < 1.5)),
    })
    e = e.join(void_cuts(edges, void_len), ["block", "bucket64"], "left").withColumn("trigger_void", sure(c("trigger_void")))
    return e.withColumn("is_cut", c("trigger_report") | c("trigger_mobile") | c("trigger_operator") | c("trigger_density") | c("trigger_void"))


def void_cuts(edges: DataFrame, void_len: int = 3, chunk_bits: int = 10) -> DataFrame:
    """(block, bucket64, trigger_void): the first boundary of each run of void_len or more empty right sides, and the one after its last.

    Runs are told apart by the running count of filled sides, in stretches of a block; their ends come from an aggregation.
    """
    n = edges.select("block", "bucket64", F.when(F.col("r_cnt") > 0, 1).otherwise(0).alias("filled"))
    at = scans.scan(n, ["block"], [F.col("bucket64")], [F.shiftright("bucket64", chunk_bits)], {"grp": ("sum", "filled")})
    zones = at.where("filled = 0").groupBy("block", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("bucket64").alias("lo"), F.max("bucket64").alias("hi")).where(F.col("n") >= void_len)
    return zones.select("block", F.explode(F.array("lo", F.col("hi") + 1)).alias("bucket64")).distinct().withColumn("trigger_void", F.lit(True))


def cut_members(df: DataFrame, cuts: DataFrame, by: str, out: str, chunk_bits: int = 16) -> DataFrame:
    """Members with the first key of their segment: every cut address is itself a member, so a running maximum of cut starts does it."""
    return cut_each(df, {out: cuts}, by, chunk_bits)


def cut_each(df: DataFrame, cuts: dict[str, DataFrame], by: str, chunk_bits: int = 16) -> DataFrame:
    """df with a column for each name of `cuts`: the greatest of these cuts up to the row's key, or the block's first key.

    Cuts stand among the members as rows of their own, so members move once for all names together. The maximum runs
    within chunks of a block's keys; what earlier chunks hand on comes from a frame of one row a block and chunk.
    """
    named = reduce(DataFrame.unionByName, [c.select(by, F.col("cut_ip").alias("ip"), F.lit(name).alias("__of")) for name, c in cuts.items()])
    marks = named.groupBy(by, "ip").agg(*[F.max(F.when(F.col("__of") == name, F.col("ip"))).alias(f"__at_{name}") for name in cuts])
    marked = df.withColumn("__mark", F.lit(False)).unionByName(marks.withColumn("__mark", F.lit(True)), allowMissingColumns=True).withColumn("__c", F.shiftright("ip", chunk_bits))
    w = Window.partitionBy(by, "__c").orderBy("ip", F.desc("__mark")).rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumns({f"__own_{name}": F.max(f"__at_{name}").over(w) for name in cuts}).where(~F.col("__mark"))
    # blocks start in a chunk of their own first member, so only cuts are handed on
    last = marks.groupBy(by, F.shiftright("ip", chunk_bits).alias("__c")).agg(*[F.max(f"__at_{name}").alias(f"__last_{name}") for name in cuts])
    long = df.groupBy(by).agg(F.max("ip").alias("hi")).where(F.shiftright("hi", chunk_bits) > F.shiftright(F.col(by), chunk_bits))
    every = long.select(by, F.explode(F.sequence(F.shiftright(F.col(by), chunk_bits), F.shiftright("hi", chunk_bits))).alias("__c"))
    earlier = Window.partitionBy(by).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(last, [by, "__c"], "left").select(by, "__c", *[F.max(f"__last_{name}").over(earlier).alias(f"__before_{name}") for name in cuts])
    fixed = marked.join(carried, [by, "__c"], "left")
    return fixed.select(*df.columns, *[F.coalesce(f"__own_{name}", f"__before_{name}", by).alias(name) for name in cuts])


def inner_jumps(df: DataFrame, by: str = "segment", width: int = 16, jump: float = 10.0, shortest: int = 64, of: tuple[str, ...] = ()) -> DataFrame:
    """Cuts inside segments of at least `shortest` addresses where the mean devices of adjacent 16-address windows jump; `of`: columns that a segment has once."""
    long = df.groupBy(by).agg(F.max("ip").alias("hi")).where(F.col("hi") - F.col(by) + 1 >= shortest)
    span = df.join(long.select(by), by, "left_semi")
    win = stage(span.groupBy(by, F.expr(f"(ip - {by}) div {width}").alias("win")).agg(F.avg("devices").alias("mean"), *[F.min(c).alias(c) for c in of]), "sub-windows")
    far = win.groupBy(by).agg(ratio(F.max("mean"), F.min("mean")).alias("most")).where(F.col("most") > jump)
    before = win.select(by, (F.col("win") + 1).alias("win"), F.col("mean").alias("before"))
    met = win.join(before, [by, "win"]).join(far.select(by), by, "left_semi")
    return met.where(wider(F.col("mean"), F.col("before")) > jump).select(by, *of, (F.col(by) + F.col("win") * width).alias("cut_ip"))


def atoms(r1: DataFrame, least: int = 7) -> DataFrame:
    return r1.groupBy("atom27").agg(F.count_if("is_valid").alias("valid_cnt")).withColumns({"density": F.col("valid_cnt") / 32.0, "is_e_atom": F.col("valid_cnt") >= least})


def runs(atom_frame: DataFrame, least: int = 3, chunk_bits: int = 16) -> tuple[DataFrame, DataFrame]:
    """(atoms with their run's first atom, runs with length and short flag)."""
    passing = islands(atom_frame.where("is_e_atom"), "atom27", chunk_bits, out="run")
    r = passing.groupBy("run").agg(F.max("atom27").alias("atom_end"), F.count(F.lit(1)).alias("run_len"))
    return passing, r.withColumns({"short_run": F.col("run_len") < least, "ip_start": F.col("run") * 32, "ip_end": F.col("atom_end") * 32 + 31})


def dotted(ip: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(ip, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])


def from_dotted(text: Column) -> Column:
    """The address of a dotted quad, null if it isn't one."""
    ok = text.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    parts = [F.try_element_at(F.split(F.when(ok, text), r"\."), F.lit(i)).cast("long") for i in range(1, 5)]
    return F.when(ok & (F.greatest(*parts) <= 255), parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3])
