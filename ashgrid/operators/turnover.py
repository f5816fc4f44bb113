"""Units that enter and leave between years: multiset difference in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def turnover(df: DataFrame, key: str, year: str, first: int, last: int) -> DataFrame:
    """(key, year, n_before, n_now, status) for every key of every pair of years that follow.

    The pair is named by its later year, from ``first + 1`` to ``last``.
    ``n_before`` and ``n_now`` count the key's rows in either year.  ``status``
    is ``entered``, ``left`` or ``stayed``; for multisets, min(n_before,
    n_now) rows are common to both years (``intersectAll``), what is above it on
    either side entered or left (``exceptAll``).

    Every (key, year) is counted once, map-side, and then stands on both
    sides: as the later year of one pair and the earlier of the next.  One
    exchange serves all pairs; nothing is joined.  Null keys are one key;
    rows without a year or outside the range are left out; a year without
    rows is an empty one: all leave before it and enter after.
    """
    cells = (df.where(F.col(year).between(first, last))
               .groupBy(key, F.col(year).cast("int").alias("__y")).agg(F.count(F.lit(1)).alias("__n")))
    sides = F.array(F.struct(F.col("__y").alias("y"), F.lit(0).cast("long").alias("a"),
                             F.col("__n").alias("b")),
                    F.struct((F.col("__y") + 1).alias("y"), F.col("__n").alias("a"),
                             F.lit(0).cast("long").alias("b")))
    pairs = (cells.select(key, F.explode(sides).alias("s"))
                  .where((F.col("s.y") > first) & (F.col("s.y") <= last))
                  .groupBy(key, F.col("s.y").alias(year))
                  .agg(F.sum("s.a").alias("n_before"), F.sum("s.b").alias("n_now")))
    return pairs.select(key, year, "n_before", "n_now", _status().alias("status"))


def _status() -> Column:
    return (F.when(F.col("n_before") == 0, "entered").when(F.col("n_now") == 0, "left")
             .otherwise("stayed"))


def turnover_totals(df: DataFrame, key: str, year: str, first: int, last: int) -> DataFrame:
    """One row per pair of years: keys that stayed, entered and left, and the same in rows."""
    rows = turnover(df, key, year, first, last)
    both = F.least("n_before", "n_now")
    return rows.groupBy(year).agg(
        F.count_if(F.col("status") == "stayed").alias("stayed"),
        F.count_if(F.col("status") == "entered").alias("entered"),
        F.count_if(F.col("status") == "left").alias("left_out"),
        F.sum(both).alias("rows_common"), F.sum(F.col("n_now") - both).alias("rows_entered"),
        F.sum(F.col("n_before") - both).alias("rows_left"))
