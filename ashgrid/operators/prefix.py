"""Running sums over a global order, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ashgrid.functions.numeric import scaled, unscaled
from ashgrid.session import checkpoint_root

_POS_BITS = 33  # monotonically_increasing_id: partition index above bit 33


def running_sum(df: DataFrame, group: str, order: list[Column], value: str,
                decimal_type: str = "decimal(18,2)", before: str = "before",
                running: str = "running", total: str = "total", place: str = "place") -> DataFrame:
    """Exact sum of ``value`` before and up to each row of its group, by ``order``.

    Adds ``place`` (from 1), ``before``, ``running`` and the group's
    ``total``.  ``order`` must leave no ties, or rows that tie follow each
    other in any order.  A null value adds nothing; rows of null group are a
    group of their own.

    A window over a group would sort it in one task, and one year may hold a
    third of all rows.  Instead one global sort by (group, order) cuts every
    group over as many tasks as its size needs; the numbered rows are
    checkpointed, so the numbering stays the same if a task reruns.  Each
    task's part of a group is summed alone, and the sums of the parts before
    it (one row per task and group) are added.
    """
    pos, part, amount = "__pos", "__part", "__amount"
    checkpoint_root(df.sparkSession)
    tagged = (df.withColumn(amount, F.coalesce(scaled(value, decimal_type), F.lit(0).cast("long")))
                .orderBy(F.col(group), *order)
                .withColumn(pos, F.monotonically_increasing_id())
                .checkpoint(eager=True)
                .withColumn(part, F.shiftright(F.col(pos), _POS_BITS)))
    parts = tagged.groupBy(part, group).agg(F.sum(amount).alias("__sum"),
                                            F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(part).alias("__spart"), F.col(group).alias("__sgroup"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__places"),
        F.sum("__sum").over(whole).alias("__total"))
    local = Window.partitionBy(part, group).orderBy(pos)
    rows = (tagged.withColumn("__local", F.sum(amount).over(
                local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                  .withColumn("__row", F.row_number().over(local)))
    on = (F.col(part) == F.col("__spart")) & F.col(group).eqNullSafe(F.col("__sgroup"))
    upto = F.col("__offset") + F.col("__local")
    return rows.join(parts, on).select(
        *(F.col(f"`{c}`") for c in df.columns), (F.col("__places") + F.col("__row")).alias(place),
        unscaled(upto - F.col(amount), decimal_type).alias(before),
        unscaled(upto, decimal_type).alias(running),
        unscaled(F.col("__total"), decimal_type).alias(total))


def concentration(df: DataFrame, group: str, key: str, value: str, percent: int,
                  decimal_type: str = "decimal(18,2)") -> DataFrame:
    """The smallest set of each group's rows that holds ``percent`` of its value.

    Rows count by falling value, equal values by ascending ``key``, so the
    set is one and the same however rows are dealt out.  Rows whose value is
    null, zero or less hold nothing and are left out; a group without others
    has no set.  Adds ``place``, ``running`` and ``total``; a row is in the
    set if the rows before it hold less than ``percent``.
    """
    some = df.where(F.col(value) > 0)
    ran = running_sum(some, group, [F.col(value).desc(), F.col(key)], value, decimal_type)
    return ran.where(_exact("before", decimal_type) * 100
                     < _exact("total", decimal_type) * percent).drop("before")


def concentration_curve(df: DataFrame, group: str, key: str, value: str,
                        percents: list[int], decimal_type: str = "decimal(18,2)") -> DataFrame:
    """(group, percent, n_members, n_units, held, total): the set's size for each percent.

    One sort serves all percents: each row joins the sets it belongs to.
    """
    some = df.where(F.col(value) > 0)
    ran = running_sum(some, group, [F.col(value).desc(), F.col(key)], value, decimal_type)
    share = F.array(*map(F.lit, percents))
    sets = F.filter(share, lambda p: _exact("before", decimal_type) * 100
                    < _exact("total", decimal_type) * p)
    units = ran.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("n_units"))
    found = (ran.select(group, F.explode(sets).alias("percent"), "running", "total")
                .groupBy(group, "percent").agg(
                    F.count(F.lit(1)).alias("n_members"), F.max("running").alias("held"),
                    F.max("total").alias("total")))
    return found.join(units, F.col(group).eqNullSafe(F.col("__g"))).select(
        group, "percent", "n_members", "n_units", "held", "total")


def _exact(c: str, decimal_type: str) -> Column:
    return scaled(c, decimal_type).cast("decimal(38,0)")
