"""Canonical values from a mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_value(c: Column, mapping: dict[str, str]) -> Column:
    """The value's entry in ``mapping``, or the value itself."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def canonical_parts(c: Column, mapping: dict[str, str], joiner: str = " E ") -> Column:
    """A text whose parts between ``joiner`` are each replaced by the mapping."""
    return F.array_join(F.transform(F.split(c, joiner), lambda p: canonical_value(p, mapping)),
                        joiner)


def canonical(df: DataFrame, col: str, mapping: dict[str, str] | DataFrame,
              out: str | None = None, key: str = "raw", value: str = "canonical") -> DataFrame:
    """Replace values found in ``mapping``; others pass through unchanged.

    A dict becomes a literal map in the plan (no join).  A DataFrame mapping
    is left-joined on its key: Spark broadcasts it when its measured size is
    under the broadcast threshold and shuffles both sides otherwise.  A key
    that the mapping repeats with one value counts once; one with two values
    fails the job, so a mapping never multiplies rows.
    """
    out = out or col
    if isinstance(mapping, dict):
        return df.withColumn(out, canonical_value(F.col(col), mapping))
    single = F.when(F.min(value) == F.max(value), F.min(value)).when(
        F.count(value) > 0, F.raise_error(F.concat(F.lit("two values for key "), F.first(key))))
    mp = (mapping.withColumn("__map_key", F.col(key)).groupBy("__map_key")
          .agg(single.alias("__map_value")))
    joined = df.join(mp, F.col(col) == F.col("__map_key"), "left")
    return (joined.withColumn(out, F.coalesce(F.col("__map_value"), F.col(col)))
                  .drop("__map_key", "__map_value"))
