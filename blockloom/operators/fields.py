"""Field configurations: which columns stay, and columns computed from two others, as data."""

from __future__ import annotations

import json
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {"+": operator.add, "-": operator.sub, "*": operator.mul}


def read_config(df_columns: list[str], text: str) -> dict:
    """The configuration in JSON text, checked against the columns; what it refuses is named.

    {"library", "fields": [{"name", "keep"}], "computed_columns": [{"name", "fieldA", "op", "fieldB"}]}. An operand is
    a column, a computed column above, or a number.
    """
    try:
        config = json.loads(text)
    except ValueError as e:
        raise ValueError(f"not a configuration: {e}") from e
    known = set(df_columns)
    names = [f["name"] for f in config.get("fields", [])]
    if unknown := sorted(set(names) - known):
        raise ValueError(f"unknown fields {unknown}")
    if len(set(names)) != len(names):
        raise ValueError("a field is listed twice")
    for c in config.get("computed_columns", []):
        if c["name"] in known:
            raise ValueError(f"column {c['name']!r} is there already")
        if c["op"] not in "+-*/" or len(c["op"]) != 1:
            raise ValueError(f"unknown operation {c['op']!r}")
        for x in (c["fieldA"], c["fieldB"]):
            if not isinstance(x, (int, float)) and x not in known:
                raise ValueError(f"unknown field {x!r} in {c['name']!r}")
        known.add(c["name"])
    return config


def project(df: DataFrame, text: str) -> DataFrame:
    """df with the fields that the configuration keeps, in df's order (unlisted ones stay), then its computed columns.

    Division gives a double, null over 0; a null operand gives null. Dropped fields may be operands.
    """
    config = read_config(df.columns, text)
    made: dict[str, Column] = {}
    value = lambda x: F.lit(x) if isinstance(x, (int, float)) else made.get(x, F.col(x) if x not in made else None)
    for c in config.get("computed_columns", []):
        a, b = value(c["fieldA"]), value(c["fieldB"])
        made[c["name"]] = F.try_divide(a.cast("double"), b.cast("double")) if c["op"] == "/" else _OPS[c["op"]](a, b)
    gone = {f["name"] for f in config.get("fields", []) if not f.get("keep", True)}
    return df.select(*[c for c in df.columns if c not in gone], *[e.alias(n) for n, e in made.items()])
