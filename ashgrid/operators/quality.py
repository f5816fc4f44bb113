"""Consistency rules reported as rows, and published-vs-recomputed totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(df: DataFrame, rules: dict[str, Column], keys: list[str],
          rule_name: str = "rule") -> DataFrame:
    """One output row per (row, broken rule): ``rule_name`` plus ``keys``.

    A rule is a boolean column that is true where the row breaks it.  All
    rules are evaluated in one pass over the data (an array of rule names,
    compacted and exploded) instead of one filtered scan per rule.
    """
    tags = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return (df.select(*keys, tags.alias("__rules"))
              .select(F.explode("__rules").alias(rule_name), *keys))


def dq_tags(df: DataFrame, rules: dict[str, Column], out: str = "dq") -> DataFrame:
    """The same rules as an array column on every row (empty when clean)."""
    tags = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.withColumn(out, tags)


def with_group_stats(df: DataFrame, groups: list[tuple[list[str], list[Column]]]) -> DataFrame:
    """Per-key aggregates joined back to every row.

    Each ``(keys, aggregates)`` is computed from ``df`` itself (not from
    the result of an earlier join) and left-joined back on plain equality
    of the keys.  Grouped aggregates combine map-side, so a hot key does
    not land in one task the way a window over it would; the joins are
    against one-row-per-key tables, which AQE broadcasts when small or
    splits when skewed, and equality keys let Spark reuse a partitioning
    the input already has.  Rows whose key is null get null aggregates: a
    row without an identity is not compared with others.
    """
    out = df
    for keys, aggs in groups:
        out = out.join(df.groupBy(*keys).agg(*aggs), list(keys), "left")
    return out


def reconcile(recomputed: DataFrame, published: DataFrame | None, key: str,
              rec_value: str = "recomputed", pub_value: str = "published",
              tol: float = 1e-6) -> DataFrame:
    """Full outer join on ``key``; every key of either side is reported once.

    status: ``ok`` (relative difference within ``tol``), ``mismatch``,
    ``missing_published``, ``missing_recomputed``, or ``conflict`` where one
    key was published with two values (the least is shown).  The columns are
    the same without published values (``None``); published rows of null key
    are left out.
    """
    r = recomputed.select(F.col(key).alias("__rk"), F.col(rec_value).alias(rec_value))
    if published is None:
        p = r.select(F.col("__rk").alias("__pk"), F.lit(None).cast("double").alias(pub_value),
                     F.lit(False).alias("__conflict")).limit(0)
    else:
        p = (published.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__pk"))
             .agg(F.min(pub_value).alias(pub_value),
                  (F.min(pub_value) != F.max(pub_value)).alias("__conflict")))
    j = r.join(p, F.col("__rk") == F.col("__pk"), "full_outer")
    diff = F.col(rec_value) - F.col(pub_value)
    ok = F.abs(diff) <= F.lit(tol) * F.greatest(F.lit(1.0), F.abs(F.col(pub_value)))
    status = (F.when(F.col("__conflict"), F.lit("conflict"))
               .when(F.col(pub_value).isNull(), F.lit("missing_published"))
               .when(F.col(rec_value).isNull(), F.lit("missing_recomputed"))
               .when(ok, F.lit("ok")).otherwise(F.lit("mismatch")))
    return j.select(F.coalesce("__rk", "__pk").alias(key), rec_value, pub_value,
                    diff.alias("diff"), status.alias("status"))
