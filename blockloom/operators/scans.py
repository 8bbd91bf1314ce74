"""Running aggregates over ordered groups that no task has to hold whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How two partial results make one; each is associative and skips nulls.
_JOIN = {"sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b), "max": lambda a, b: F.greatest(a, b), "min": lambda a, b: F.least(a, b), "last": lambda a, b: F.coalesce(b, a)}
_OVER = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}


def scan(df: DataFrame, by: list[str], order: list[Column], chunk: list[Column], steps: dict[str, tuple[str, str]]) -> DataFrame:
    """df with, for each name of `steps`, the (sum, max, min, last) of a column over the group's rows up to this one.

    order: unique within a group. chunk: columns of the group's rows that never fall as `order` rises, such as the high
    bits of its first key; they cut a group into stretches. A window runs inside a stretch; what earlier stretches hand
    on comes from a second one over one row a stretch, so the longest thing a task sees is the larger of a stretch and
    a group's number of stretches. Nulls are skipped; before the first value the result is null.
    """
    parts = [f"__c{i}" for i in range(len(chunk))]
    d = df.withColumns(dict(zip(parts, chunk, strict=True)))
    inside = Window.partitionBy(*by, *parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"__own_{n}": _OVER[kind](F.col(c)).over(inside) for n, (kind, c) in steps.items()})
    # a stretch's total: of a step that keeps the last value, by the greatest place in order
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    total = {n: (F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)) if kind == "last" else _OVER[kind](F.col(c))).alias(f"__all_{n}") for n, (kind, c) in steps.items()}
    whole = df.withColumns(dict(zip(parts, chunk, strict=True))).groupBy(*by, *parts).agg(*total.values())
    across = Window.partitionBy(*by).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    carry = whole.select(*by, *parts, *[_OVER[kind](F.col(f"__all_{n}")).over(across).alias(f"__before_{n}") for n, (kind, _) in steps.items()])
    out = d.join(carry, [*by, *parts])
    return out.select(*df.columns, *[_JOIN[kind](F.col(f"__before_{n}"), F.col(f"__own_{n}")).alias(n) for n, (kind, _) in steps.items()])
