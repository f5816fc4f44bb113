"""Burned area by cause: row totals, class subtotals, wide to long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.functions.numeric import component_sum, exact_sum

# Raw cause columns of the yearly tables and the cause each
# one stands for.  Firebreak, indigenous and lightning rest on similar names
# only; MIF is a mix and stays its own class.
CAUSE_OF = {
    "Incendio": "wildfire",
    "Queima_prescrita": "prescribed",
    "Queima_controlada": "controlled",
    "Fogo_natural": "natural",
    "Aceiro_negro": "firebreak",
    "Aceiro": "firebreak",
    "Queima_indig_isol": "indigenous",
    "Queima_indigena": "indigenous",
    "Indigena_isolado": "indigenous",
    "Gestao_raio": "lightning",
    "Raio": "lightning",
    "MIF": "managed_unsplit",
}

# The two published subtotals and the causes they add up.
CLASSES = {
    "prevention": ("prescribed", "controlled", "firebreak", "indigenous"),
    "combat": ("wildfire", "natural"),
}

CAUSES = ("wildfire", "prescribed", "controlled", "firebreak", "natural",
          "indigenous", "lightning", "managed_unsplit")


def component_total(df: DataFrame, parts: list[str], out: str = "causes_total",
                    decimal_type: str | None = None) -> DataFrame:
    """Row-wise sum of the part columns (null only if all parts are null)."""
    present = [p for p in parts if p in df.columns]
    return df.withColumn(out, component_sum(present, decimal_type))


def class_totals(df: DataFrame, classes: dict[str, tuple[str, ...]] = CLASSES,
                 decimal_type: str | None = None) -> DataFrame:
    """One subtotal column per class, over the cause columns present."""
    cols = {}
    for name, members in classes.items():
        present = [m for m in members if m in df.columns]
        cols[name] = component_sum(present, decimal_type) if present else F.lit(None).cast("double")
    return df.withColumns(cols)


def unpivot_causes(df: DataFrame, ids: list[str], cause_cols: list[str],
                   cause_of: dict[str, str] | None = None,
                   raw_name: str = "cause_raw", value_name: str = "area",
                   cause_name: str = "cause") -> DataFrame:
    """Wide cause columns to (ids..., cause_raw, cause, area).

    Null cells are dropped (the cause was not split out that year); zeros
    are kept.  ``cause_of`` maps a raw column name to its cause; the map is a
    literal in the plan, so no join and no shuffle is needed.
    """
    long = (df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cause_cols])
              .unpivot(ids, cause_cols, raw_name, value_name)
              .filter(F.col(value_name).isNotNull()))
    if cause_of:
        m = F.create_map(*[F.lit(x) for kv in cause_of.items() for x in kv])
        long = long.withColumn(cause_name, F.coalesce(F.try_element_at(m, F.col(raw_name)),
                                                      F.col(raw_name)))
    else:
        long = long.withColumn(cause_name, F.col(raw_name))
    return long.select(*ids, raw_name, cause_name, value_name)


def cause_totals(long: DataFrame, keys: list[str], cause_name: str = "cause",
                 value_name: str = "area", out: str = "area",
                 decimal_type: str = "decimal(38,10)") -> DataFrame:
    """Re-sum the long form by ``keys`` + cause (decimal, order-free)."""
    return (long.groupBy(*keys, cause_name)
                .agg(exact_sum(value_name, decimal_type).alias(out)))
