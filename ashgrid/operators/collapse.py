"""Collapse rows that share a key, keeping provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.functions.numeric import exact_sum


def collapse(df: DataFrame, keys: list[str], sum_cols: list[str] = (),
             max_cols: list[str] = (), set_cols: dict[str, str] | None = None,
             array_cols: list[str] = (), row_cols: list[str] = (),
             sources: list[str] = (), count_as: str | None = "n_rows",
             decimal_type: str = "decimal(38,10)") -> DataFrame:
    """One row per key.

    ``sum_cols`` are added exactly (``exact_sum``), ``max_cols`` take the maximum,
    ``row_cols`` are taken together from one row (the greatest by these columns
    in their order, nulls least), so they never mix rows, ``sources`` become
    the sorted array ``sources`` of the distinct rows' structs of these columns,
    ``set_cols`` ({col: separator}) become the sorted distinct values joined
    by the separator, ``array_cols`` become the sorted union of the arrays.
    Everything is a partial-then-final aggregate: ``collect_set`` holds the
    distinct values only, so a hot key does not build a long list in one
    task.
    """
    aggs = [exact_sum(c, decimal_type).alias(c) for c in sum_cols]
    aggs += [F.max(c).alias(c) for c in max_cols]
    if row_cols:
        aggs.append(F.max(F.struct(*row_cols)).alias("__row"))
    if sources:
        aggs.append(F.array_sort(F.collect_set(F.struct(*sources))).alias("sources"))
    for c, sep in (set_cols or {}).items():
        aggs.append(F.array_join(F.array_sort(F.collect_set(c)), sep).alias(c))
    for c in array_cols:
        aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c))
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    out = df.groupBy(*keys).agg(*aggs)
    if row_cols:
        out = out.select("*", *(F.col("__row")[c].alias(c) for c in row_cols)).drop("__row")
    return out
