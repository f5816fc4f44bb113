"""Years a unit burned in: runs, gaps, and change from year to year.

Windows here partition by the unit over a (unit, year) grain, so a window
holds at most one row per year; rows that repeat a year are summed or counted
before, map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ashgrid.functions.numeric import exact_sum


def last_year(df: DataFrame, year: str) -> int | None:
    """The latest year of the table (one small job); none if it is empty."""
    return df.agg(F.max(year)).first()[0]


def streaks(df: DataFrame, key: str, year: str) -> DataFrame:
    """(key, run, first, last, length): unbroken runs of years with a row, numbered from 1.

    Years that follow each other keep the same difference between year and
    row number, so that difference names the run (gaps and islands).
    Repeated years count once; rows without a year are left out.
    """
    years = df.where(F.col(year).isNotNull()).select(key, F.col(year).alias("y")).distinct()
    by_year = Window.partitionBy(key).orderBy("y")
    island = (years.withColumn("island", F.col("y") - F.row_number().over(by_year))
                   .groupBy(key, "island").agg(F.min("y").alias("first"), F.max("y").alias("last"),
                                               F.count(F.lit(1)).alias("length")))
    return island.select(key, F.row_number().over(Window.partitionBy(key).orderBy("first"))
                         .alias("run"), "first", "last", "length")


def recurrence(df: DataFrame, key: str, year: str, until: int | None = None) -> DataFrame:
    """One row per key: years with a row, runs, the longest one, the current one, years absent.

    The longest run is the earliest of the longest; the current one ends in
    ``until`` (the table's last year unless given), else its length is 0.
    ``absent_between`` counts the years missing between the first and the
    last, ``absent_since`` those after the last.
    """
    until = last_year(df, year) if until is None else until
    end = F.lit(until).cast("int")
    return streaks(df, key, year).where(F.col("first") <= end).groupBy(key).agg(
        F.sum("length").alias("n_years"), F.count(F.lit(1)).alias("n_runs"),
        F.min("first").alias("first_year"), F.max("last").alias("last_year"),
        F.max("length").alias("longest_run"),
        (-F.max(F.struct("length", -F.col("first")))["col2"]).alias("longest_from"),
        F.max(F.when(F.col("last") == end, F.col("length")).otherwise(0)).alias("current_run"),
    ).select("*", (F.col("last_year") - F.col("first_year") + 1 - F.col("n_years"))
             .alias("absent_between"), (end - F.col("last_year")).alias("absent_since"))


def every_year(df: DataFrame, key: str, year: str, values: list[str],
               until: int | None = None) -> DataFrame:
    """A row for each year from a key's first to its last (or to ``until``): (key, year, values, present).

    Each row also makes the rows of the missing years up to the next one, so
    nothing is joined, and no key meets a year outside its own span.  Values
    of a missing year are null and ``present`` is false: null is not zero.
    Needs one row per key and year.
    """
    own = Window.partitionBy(key).orderBy(year)
    end = F.lead(year).over(own) - 1
    if until is not None:
        end = F.coalesce(end, F.greatest(F.col(year), F.lit(until)))
    span = F.sequence(F.col(year), F.coalesce(end, F.col(year)))
    long = df.select(key, F.col(year).alias("__own"), *values, span.alias("__span")).select(
        key, "__own", *values, F.explode("__span").alias(year))
    here = F.col(year) == F.col("__own")
    return long.select(key, year, *(F.when(here, F.col(v)).alias(v) for v in values),
                       here.alias("present"))


def yearly_change(df: DataFrame, key: str, year: str, value: str,
                  decimal_type: str = "decimal(18,2)", until: int | None = None) -> DataFrame:
    """Change from the year before, with a row for every missing year between.

    Adds to (key, year, value, present): ``before``, the value of the year
    before (null if it is missing or without a value); ``known``, the last
    value at all, and ``known_year``; ``change`` and ``change_pct`` against
    ``before`` (the percent is null where that is 0); and ``kind``: ``first``,
    ``gap`` (no row), ``unknown`` (a row without a value), ``back`` (a value
    after a year without one), ``from_zero``, ``to_zero``, ``up``, ``down`` or
    ``same``.
    """
    rows = every_year(df, key, year, [value], until)
    own = Window.partitionBy(key).orderBy(year)
    past = own.rowsBetween(Window.unboundedPreceding, -1)
    v, b = F.col(value), F.col("before")
    rows = rows.select(
        "*", F.lag(value).over(own).alias("before"),
        F.last(value, ignorenulls=True).over(past).alias("known"),
        F.last(F.when(v.isNotNull(), F.col(year)), ignorenulls=True).over(past).alias("known_year"),
        F.row_number().over(own).alias("__n"))
    change = (v.cast(decimal_type) - b.cast(decimal_type)).cast("double")
    kind = (F.when(~F.col("present"), "gap").when(v.isNull(), "unknown")
             .when(F.col("__n") == 1, "first").when(b.isNull(), "back")
             .when((b == 0) & (v == 0), "same").when(b == 0, "from_zero").when(v == 0, "to_zero")
             .when(v > b, "up").when(v < b, "down").otherwise("same"))
    return rows.select(
        key, year, value, "present", "before", "known", "known_year", change.alias("change"),
        F.when(b != 0, F.lit(100) * change / F.abs(b)).alias("change_pct"), kind.alias("kind"))


def moving(df: DataFrame, key: str, year: str, value: str, span: int,
           decimal_type: str = "decimal(18,2)") -> DataFrame:
    """Running total and means over the last ``span`` years and over the last ``span`` rows.

    ``years_mean`` looks back by the distance of years: a missing year
    shortens it.  ``rows_mean`` looks back by rows: after a missing year it
    reaches further back.  Null values are not counted; the running total
    before the first value is null.  Sums are exact.
    """
    own = Window.partitionBy(key).orderBy(year)
    frames = {"total": own.rangeBetween(Window.unboundedPreceding, Window.currentRow),
              "years": own.rangeBetween(1 - span, Window.currentRow),
              "rows": own.rowsBetween(1 - span, Window.currentRow)}

    def summed(frame: str) -> F.Column:
        return exact_sum(value, decimal_type, frames[frame])

    def counted(frame: str) -> F.Column:
        return F.count(value).over(frames[frame])

    return df.select(
        key, year, value, summed("total").alias("running_total"),
        counted("years").alias("years_n"),
        F.try_divide(summed("years"), counted("years")).alias("years_mean"),
        counted("rows").alias("rows_n"),
        F.try_divide(summed("rows"), counted("rows")).alias("rows_mean"))
