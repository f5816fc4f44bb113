"""One column per year, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.functions.numeric import exact_sum


def pivot_years(df: DataFrame, key: str, year: str, value: str, years: list[int],
                prefix: str = "y", other: str = "other",
                decimal_type: str = "decimal(18,2)") -> DataFrame:
    """(key, one column per stated year, other): exact sums; a year without rows is null.

    The columns are stated, so no job looks for them and the schema is the
    same whatever the data hold; years that are not stated (a null year too)
    add up in ``other`` instead of being dropped.
    """
    stated = F.col(year).isin(*years)
    column = F.when(stated, F.concat(F.lit(prefix), F.col(year).cast("string"))).otherwise(other)
    wide = df.select(key, value, F.coalesce(column, F.lit(other)).alias("__year"))
    return wide.groupBy(key).pivot("__year", [*(f"{prefix}{y}" for y in years), other]).agg(
        exact_sum(value, decimal_type))


def unpivot_years(wide: DataFrame, key: str, years: list[int], value: str = "value",
                  year: str = "yr", prefix: str = "y") -> DataFrame:
    """(key, year, value) of the stated columns that are not null: the inverse of ``pivot_years``."""
    long = wide.unpivot([key], [f"{prefix}{y}" for y in years], "__year", value)
    return long.where(F.col(value).isNotNull()).select(
        key, F.substring("__year", len(prefix) + 1, 10).cast("int").alias(year), value)
