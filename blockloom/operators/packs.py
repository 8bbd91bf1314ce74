"""Rule packs as a table: each has rules for one library and may inherit those of a parent pack."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.operators import rules

SCHEMA = "id long, name string, target_lib string, parent_id long, rules_json string"


def resolved(packs: DataFrame) -> DataFrame:
    """(id, name, target_lib, depth, source_id, rules_json): a row for each pack and each pack that it has rules from.

    Parents are joined level by level until none is left. A pack that is its own ancestor, a parent that isn't there
    and a parent for another library are refused, by name.
    """
    up = packs.select(F.col("id").alias("parent"), F.col("target_lib").alias("lib"), F.col("parent_id").alias("next"), F.col("rules_json").alias("more"))
    level = packs.select("id", "name", "target_lib", F.lit(0).alias("depth"), F.col("id").alias("source_id"), "rules_json", F.col("parent_id").alias("next"))
    out = None
    while True:
        done = level.drop("next")
        out = done if out is None else out.unionByName(done)
        open_ = level.where("next is not null").withColumnRenamed("next", "parent")
        found = open_.join(up, "parent", "left")
        # a row for each pack whose chain goes on; they are rules that people wrote
        rows = found.select("id", "name", "parent", "target_lib", "lib", F.col("lib").isNull().alias("gone"), (F.col("parent") == F.col("id")).alias("again")).collect()
        if not rows:
            return out
        for r in rows:
            if r.gone:
                raise ValueError(f"pack {r['name']!r}: there is no parent {r.parent}")
            if r.again:
                raise ValueError(f"pack {r['name']!r} is its own ancestor")
            if r.lib != r.target_lib:
                raise ValueError(f"pack {r['name']!r}: its parent {r.parent} is for {r.lib}")
        level = found.select("id", "name", "target_lib", (F.col("depth") + 1).alias("depth"), F.col("parent").alias("source_id"), F.col("more").alias("rules_json"), "next")


def compiled(packs: DataFrame, library: str) -> dict[str, dict]:
    """{pack: rule} for one library: all of a pack's own and inherited rules, the eldest ancestor's first."""
    rows = resolved(packs).where(F.col("target_lib") == library).orderBy("name", F.desc("depth")).collect()  # a row a pack and ancestor
    out: dict[str, dict] = {}
    for r in rows:
        own = [{"field": x["metric"], "op": x["op"], "value": x["val"]} for x in json.loads(r.rules_json)]
        out.setdefault(r["name"], {"all": []})["all"] += own
    return out


def matches(df: DataFrame, packs: DataFrame, library: str, key: str) -> DataFrame:
    """(pack, key) of the rows of df that meet all rules of a pack; one pass, whatever the number of packs.

    A rule over a null is false; a pack without rules takes every row; fields that df lacks are refused.
    """
    found = [F.when(rules.compile_rule(rule, df.columns), F.lit(name)) for name, rule in compiled(packs, library).items()]
    if not found:
        return df.select(F.lit(None).cast("string").alias("pack"), key).limit(0)
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("pack")).select("pack", key)
