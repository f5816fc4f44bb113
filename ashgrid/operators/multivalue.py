"""Exploding multi-value fields without double counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_values(df: DataFrame, col: str, out: str, value_cols: list[str] = (),
                   allocate: str = "none") -> DataFrame:
    """One row per element of the array ``col``.

    ``allocate="equal"`` divides each of ``value_cols`` by the number of
    elements, so the exploded rows add up to the original row (a unit seen
    by two sensors gives each half its area).  ``"none"`` copies the values,
    and sums over the exploded rows then count a row once per element.
    Rows whose array is null or empty produce no row.
    """
    if allocate not in ("none", "equal"):
        raise ValueError(allocate)
    n = F.size(col)
    df = df.where(n > 0)
    if allocate == "equal" and value_cols:
        df = df.withColumns({v: F.col(v) / n for v in value_cols})
    return df.withColumn(out, F.explode(col)).drop(col)
