"""Totals with subtotals: aggregated to the finest grain once, then expanded."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.functions.numeric import scaled, unscaled


def grouping_sets(keys: list[str], kind: str) -> list[list[str]]:
    """The sets of keys of a ``rollup`` or a ``cube``, finest first."""
    if kind == "rollup":
        return [keys[:n] for n in range(len(keys), -1, -1)]
    if kind == "cube":
        return [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)]
    raise ValueError(f"rollup or cube, not {kind!r}")


def subtotals(df: DataFrame, keys: list[str], values: list[str], sets: str | list[list[str]] = "rollup",
              decimal_type: str = "decimal(18,2)", level: str = "level",
              count_as: str = "n_rows") -> DataFrame:
    """Exact sums of ``values`` for every set of keys: a ``rollup``, a ``cube`` or the sets given.

    ``level`` is the grouping id: one bit per key, the first highest, set
    where the row sums over that key.  A null key of the data has its bit
    clear, so it is told from a subtotal.  Rows are aggregated by all keys
    first, map-side; what is expanded is one row per combination of keys, not
    one per row of the table.  No rows give no totals.
    """
    sums = [F.sum(scaled(v, decimal_type)).alias(v) for v in values]
    fine = df.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias(count_as))
    wanted = grouping_sets(keys, sets) if isinstance(sets, str) else sets
    out = fine.groupingSets([[F.col(k) for k in s] for s in wanted], *keys).agg(
        F.grouping_id(*keys).cast("int").alias(level),
        *(F.sum(v).alias(v) for v in values), F.sum(count_as).alias(count_as))
    return out.select(*keys, level, *(unscaled(v, decimal_type).alias(v) for v in values), count_as) \
        .where(F.col(count_as).isNotNull())
