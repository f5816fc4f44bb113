"""Attribute history over years: as-of fill and type-2 versions.

The window of the as-of fill partitions by the unit key over a (unit, year)
grain, so one window group holds at most one row per year; run ``collapse``
first when a key can repeat inside a year.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def asof_fill(df: DataFrame, key: str, order: str, attr: str,
              out: str | None = None) -> DataFrame:
    """Last non-null ``attr`` at or before this row's ``order`` value.

    Never looks ahead: rows before the first known value stay null.
    """
    w = (Window.partitionBy(key).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out or attr, F.last(attr, ignorenulls=True).over(w))


def change_flags(df: DataFrame, key: str, order: str, attr: str, tol: float | None,
                 opened: str = "opened", flag: str = "changed",
                 version: str = "version") -> DataFrame:
    """The value that opened each row's version, a change flag, a version number.

    The first non-null value opens version 1.  A later row opens a new one
    when its value is off the opening value of the running version by more
    than ``tol`` relative to it (numbers: rewrites of the last digits stay, a
    slow drift does not) or, with ``tol=None``, whenever it differs at all
    (text, arrays).  A row without a value keeps the version (0 before any).
    Rows of a repeated (key, order) follow each other by value.

    Which value opened a version depends on all versions before, a recursion
    that neither windows nor aggregates express: rows are dealt out by key and
    sorted, and one pass over each partition carries the running version
    from row to row, so no list of a key's rows is ever made.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(opened, df.schema[attr].dataType),
                           T.StructField(flag, T.IntegerType()),
                           T.StructField(version, T.IntegerType())])
    at_key, at_attr = df.columns.index(key), df.columns.index(attr)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        now, base, number = object(), None, 0
        for batch in batches:
            bases, changed, numbers = [], [], []
            for k, a in zip(batch.column(at_key).to_pylist(), batch.column(at_attr).to_pylist()):
                if k != now:
                    now, base, number = k, None, 0
                new = a is not None and (base is None or (
                    a != base if tol is None else abs(a - base) > tol * abs(base)))
                if new:
                    base, number = a, number + 1
                bases.append(base)
                changed.append(int(new))
                numbers.append(number)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bases, batch.column(at_attr).type),
                 pa.array(changed, pa.int32()), pa.array(numbers, pa.int32())],
                names=[*batch.schema.names, opened, flag, version])

    return df.repartition(key).sortWithinPartitions(key, order, attr).mapInArrow(run, schema)


def history(df: DataFrame, key: str, order: str, attr: str, tol: float | None,
            value: str = "value", valid_from: str = "valid_from",
            valid_to: str = "valid_to", version: str = "version") -> DataFrame:
    """Type-2 history: one row per (key, version) with the value that opened
    the version and the first and last ``order`` value it covers.  Rows
    before the key's first known value (version 0) describe no value and
    are left out."""
    flagged = change_flags(df, key, order, attr, tol, version=version)
    return (flagged.where(F.col(version) > 0).groupBy(key, version)
                   .agg(F.first("opened").alias(value),
                        F.min(order).alias(valid_from),
                        F.max(order).alias(valid_to),
                        F.count(F.lit(1)).alias("n_rows")))
