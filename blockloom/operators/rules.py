"""Rules as data: conditions compiled to columns, and an ordered funnel of exclusive tags.

A rule is one of
  {"field", "op", "value"}            op: = != < <= > >= in
  {"all": [rules]} / {"any": [rules]}
  {"field", "op", "by", "bands"}      tiered: bands is [(upper bound of `by`, threshold)], the last bound may be None; a
                                      threshold of 0 always passes
  {"needs": [rules], "dims": [rules], "failed": t}   all of `needs`, and at least t of `dims` hold
A condition that is null counts as false, so a funnel loses no rows.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OPS = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def compile_rule(rule: dict, fields: Iterable[str]) -> Column:
    """The rule as a Boolean column that is never null; fields outside the list are refused."""
    fields = set(fields)

    def known(name: str) -> Column:
        if name not in fields:
            raise ValueError(f"unknown field {name!r}")
        return F.col(name)

    def build(r: dict) -> Column:
        if "all" in r or "any" in r:
            parts = [build(x) for x in r.get("all", r.get("any"))]
            start = F.lit("all" in r)
            return reduce(operator.and_ if "all" in r else operator.or_, parts, start)
        if "dims" in r:
            count = reduce(operator.add, [build(x).cast("int") for x in r["dims"]])
            return reduce(operator.and_, [build(x) for x in r.get("needs", [])], count >= r["failed"])
        left = known(r["field"])
        if "bands" in r:
            by, passed = known(r["by"]), None
            for bound, threshold in r["bands"]:
                here = F.lit(True) if threshold == 0 else _OPS[r["op"]](left, F.lit(threshold))
                if bound is None:
                    passed = here if passed is None else passed.otherwise(here)
                    break
                passed = F.when(by <= bound, here) if passed is None else passed.when(by <= bound, here)
            return F.coalesce(passed, F.lit(False))
        if r["op"] == "in":
            return F.coalesce(left.cast("string"), F.lit("")).isin(*[str(v) for v in r["value"]])
        return F.coalesce(_OPS[r["op"]](left, F.lit(r["value"])), F.lit(False))

    return build(rule)


def tag(df: DataFrame, tags: list[tuple[str, dict]], out: str = "tag") -> DataFrame:
    """Each row's first matching tag, null where none matches."""
    chain = None
    for name, rule in tags:
        hit = compile_rule(rule, df.columns)
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return df.withColumn(out, F.lit(None).cast("string") if chain is None else chain)


def funnel(df: DataFrame, tags: list[tuple[str, dict]], measures: list[str]) -> DataFrame:
    """One row a tag, in order: rows and measures it took, and what was left after it. One pass over df."""
    place = F.create_map(*[x for i, (name, _) in enumerate(tags) for x in (F.lit(name), F.lit(i))])
    step = F.coalesce(place[F.col("tag")], F.lit(len(tags)))
    took = tag(df, tags).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures])
    steps = df.sparkSession.createDataFrame([(i, name) for i, (name, _) in enumerate(tags)] + [(len(tags), None)], "step int, tag string")
    every = steps.join(took, "step", "left").fillna(0, ["rows", *measures])
    # as many rows as there are tags
    w = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    left = [F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_left") for c in ("rows", *measures)]
    return every.select("step", "tag", "rows", *measures, *left).where(F.col("step") < len(tags))
