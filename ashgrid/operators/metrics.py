"""Yearly totals, newest-first order, the published layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.functions.numeric import exact_sum


def yearly_total(df: DataFrame, year: str = "yr", value: str = "area",
                 out: str = "area_total", decimal_type: str = "decimal(38,10)",
                 count_as: str | None = "n_rows") -> DataFrame:
    """Sum of ``value`` per year: every row counts, nothing filtered or
    de-duplicated.

    The sum is exact (``exact_sum``), so the total is the same whatever
    order the partial sums arrive in; Spark plans it as a partial aggregate before the
    shuffle and a final one after, so a year holding most rows is already
    reduced to one row per map task when it crosses the network.
    """
    aggs = [exact_sum(value, decimal_type).alias(out)]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return df.groupBy(year).agg(*aggs)


def newest_first(df: DataFrame, year: str = "yr") -> DataFrame:
    return df.orderBy(F.col(year).desc())


# Column names and order of the published totals table.
TOTALS_COLUMNS = ("AREA_QUEIM_ANO", "ano")


def as_totals_layout(df: DataFrame, value: str = "area_total",
                     year: str = "yr") -> DataFrame:
    """Yearly totals in the published layout: value first, then year,
    newest year first."""
    return newest_first(df, year).select(
        F.col(value).alias(TOTALS_COLUMNS[0]),
        F.col(year).cast("int").alias(TOTALS_COLUMNS[1]))
