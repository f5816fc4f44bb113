"""From a folder of yearly tables to the canonical tables.

    unit_year   one row per source row, cleaned and typed, with a ``dq``
                array of the rules the row breaks
    unit_cells  one row per (unit_key, year) after collapsing duplicates,
                biome filled as of the year
    cause_area  burned area by (year, unit_key, cause), long form
    unit_dim    size history of each unit (type 2)
    biome_dim   biome history of each unit (type 2)
    violations  one row per (source row, broken rule)
    totals      recomputed yearly totals beside the published ones
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ashgrid.functions import (category, clean_text, null_if, parse_date,
                               percent_of, split_known, split_values, unit_key)
from ashgrid.functions.numeric import component_sum, exact_sum
from ashgrid.operators.canonical import canonical_parts
from ashgrid.operators.causes import CAUSE_OF, class_totals, unpivot_causes
from ashgrid.operators.collapse import collapse
from ashgrid.operators.fuzzy import fuzzy_pairs
from ashgrid.operators.history import asof_fill, history
from ashgrid.operators.metrics import yearly_total
from ashgrid.operators.quality import check, dq_tags, reconcile, with_group_stats
from ashgrid.session import checkpoint_root
from ashgrid.sources.layouts import CAUSE_HEADERS, CAUSE_PREFIX
from ashgrid.sources.yearly_csv import (detect_layouts, list_files, read_totals, read_year,
                                        union_years)

# Biome names, and the misspelling found in the tables.
KNOWN_BIOMES = ("AMAZONIA", "CAATINGA", "CERRADO", "MARINHO COSTEIRO", "MATA ATLANTICA",
                "PAMPA", "PANTANAL")
BIOME_SPELLING = {"MATA ATANTICA": "MATA ATLANTICA"}
NO_GROUP = "-"
DATED_LAYOUTS = ("L1", "L2", "L3", "L4")
ROUNDED_PCT_LAYOUTS = ("L5", "L6")   # percent printed with 2 decimals

CAUSE_COLUMNS = tuple(CAUSE_PREFIX + h for h in CAUSE_HEADERS)
# Sums go through this decimal: printed values add up exactly (0.1 + 0.2 is
# 0.3) and an aggregate does not depend on the order partial sums arrive in.
# 12 decimals keep values under 9.2e6 on Spark's long-backed fast path.
EXACT = "decimal(38,12)"
SIZE_TOL = 0.5       # size rule: within 50 % of the unit's median size
HISTORY_TOL = 0.01   # a size change under 1 % is a rewrite, not a new version


def _ensure(df: DataFrame, cols) -> DataFrame:
    kinds = {"source_time": "timestamp", "bad_numbers": "array<string>"}
    missing = {c: F.lit(None).cast("double" if c.startswith(CAUSE_PREFIX)
                                   else kinds.get(c, "string"))
               for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def conform_units(raw: DataFrame) -> DataFrame:
    """Typed, cleaned columns of our schema (one row per source row)."""
    df = _ensure(raw, ["biome_raw", "sensor_raw", "mgmt_group_raw", "last_update_raw",
                       "prevention_published", "combat_published", "malformed_row",
                       "source_time", "bad_numbers",
                       *CAUSE_COLUMNS])
    df = df.withColumns({"unit": clean_text("unit_raw"), "biome_clean": clean_text("biome_raw")})
    df = df.withColumns({
        "unit_key": unit_key("unit"),
        "category": category("unit"),
        "biomes_as_written": split_known("biome_clean", KNOWN_BIOMES),
    })
    # each part of a list gets its canonical spelling, then the list is split
    df = df.withColumn("biome_clean", canonical_parts(F.col("biome_clean"), BIOME_SPELLING))
    df = df.withColumns({
        "biomes": split_known("biome_clean", KNOWN_BIOMES),
        "mgmt_group": null_if(clean_text("mgmt_group_raw"), NO_GROUP),
        "sensors": split_values(clean_text("sensor_raw")),
        "last_update": parse_date("last_update_raw"),
        "pct": percent_of("area_total", "area_unit"),
        "causes_total": component_sum(list(CAUSE_COLUMNS), EXACT),
    })
    return df.select("yr", "src_row", "unit_raw", "unit", "unit_key", "category", "biome_raw",
                     "biome_clean", "biomes_as_written", "biomes", "mgmt_group", "sensors",
                     "last_update_raw", "last_update", "area_total", "area_unit",
                     "pct_published", "pct", "causes_total", "prevention_published",
                     "combat_published", *CAUSE_COLUMNS, "source_file", "source_time", "layout", "malformed_row",
                     "bad_numbers")


def quality_rules() -> dict:
    """Rules of the blueprint; each is true where a row breaks it."""
    known = [F.lit(b) for b in KNOWN_BIOMES]
    return {
        "causes_mismatch": F.abs(F.col("area_total") - F.col("causes_total"))
                           > F.lit(1e-6) * F.greatest(F.lit(1.0), F.abs(F.col("area_total"))),
        "date_outside_year": (F.year("last_update") < F.col("yr"))
                             | (F.year("last_update") > F.col("yr") + 1),
        "date_missing": F.col("layout").isin(*DATED_LAYOUTS) & F.col("last_update").isNull(),
        "duplicate_key": F.col("key_count") > 1,
        "size_far_from_median": F.abs(F.col("area_unit") - F.col("size_median"))
                                > F.lit(SIZE_TOL) * F.abs(F.col("size_median")),
        "name_not_clean": F.col("unit_raw") != F.col("unit"),
        "unknown_biome": F.col("biome_raw").isNotNull()
                         & (F.size(F.array_except("biomes_as_written", F.array(*known))) > 0),
        "pct_out_of_range": (F.col("pct") < 0) | (F.col("pct") > 100),
        # published percent vs recomputed: full precision, or 2 decimals
        # (half a unit of the last digit, whatever the tie rule)
        "pct_mismatch": F.when(F.col("layout").isin(*ROUNDED_PCT_LAYOUTS),
                               F.abs(F.col("pct") - F.col("pct_published")) > F.lit(0.005 + 1e-9))
                         .otherwise(F.abs(F.col("pct") - F.col("pct_published"))
                                    > F.lit(1e-6) * F.greatest(F.lit(1.0), F.abs(F.col("pct")))),
        # different names on one key in one year: the key merged too much
        "key_collision": F.col("key_names") > 1,
        # too few or too many fields on the line (raw text kept, no values)
        "malformed_row": F.col("malformed_row").isNotNull(),
        # no year in the file's path: the row is in no yearly total
        "year_missing": F.col("yr").isNull(),
        # text that is no finite number in range: null in the typed column
        "number_out_of_range": F.col("bad_numbers").isNotNull(),
    }


def with_rule_inputs(units: DataFrame) -> DataFrame:
    return with_group_stats(units, [
        (["unit_key", "yr"], [F.count(F.lit(1)).alias("key_count"),
                              F.count_distinct("unit").alias("key_names")]),
        (["unit_key"], [F.median("area_unit").alias("size_median")]),
    ])


def read_folder(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(yearly rows of every layout, published totals or None)."""
    groups = detect_layouts(spark, list_files(spark, path))
    totals_files = groups.pop("LT", None)
    if not groups:
        raise ValueError(f"no yearly tables under {path}")
    rows = union_years([read_year(spark, fs, lid) for lid, fs in sorted(groups.items())])
    totals = read_totals(spark, totals_files) if totals_files else None
    return rows, totals


def build(spark: SparkSession, path: str | list[str],
          units_table: str | None = None) -> dict[str, DataFrame]:
    """All canonical tables for the yearly tables under ``path``.

    The CSV text is parsed once, however many tables are derived: the
    conformed rows are written to ``units_table`` as parquet partitioned by
    year when given, else checkpointed into the shared checkpoint folder.
    """
    raw, published = read_folder(spark, path)
    conformed = conform_units(raw)
    if units_table:
        conformed.write.mode("overwrite").partitionBy("yr").parquet(units_table)
        conformed = spark.read.parquet(units_table)
    else:
        checkpoint_root(spark)
        conformed = conformed.checkpoint(eager=True)
    units = with_rule_inputs(conformed)
    rules = quality_rules()
    unit_year_df = dq_tags(units, rules)
    violations = check(units, rules, ["yr", "src_row", "unit", "unit_key", "source_file"])

    # malformed rows have no unit and no values
    whole = units.where(F.col("malformed_row").isNull())
    cells = collapse(whole, ["unit_key", "yr"], sum_cols=["area_total"],
                     row_cols=["area_unit", "last_update", "unit", "category", "mgmt_group"],
                     array_cols=["sensors", "biomes"], sources=["source_file", "src_row"],
                     decimal_type=EXACT)
    cells = cells.withColumn("biomes", F.when(F.size("biomes") > 0, F.col("biomes")))
    cells = asof_fill(cells, "unit_key", "yr", "biomes", "biomes_asof")
    cells = cells.withColumn("pct", percent_of("area_total", "area_unit"))

    cause_of = {CAUSE_PREFIX + k: v for k, v in CAUSE_OF.items()}
    long = unpivot_causes(units, ["yr", "unit_key", "src_row", "source_file"],
                          list(CAUSE_COLUMNS), cause_of)
    long = long.withColumn("cause_raw", F.regexp_replace("cause_raw", "^" + CAUSE_PREFIX, ""))
    cause_area = (long.groupBy("yr", "unit_key", "cause_raw", "cause")
                      .agg(exact_sum("area", EXACT).alias("area")))

    unit_dim = history(cells, "unit_key", "yr", "area_unit", HISTORY_TOL,
                       value="area_unit")
    biome_dim = history(cells, "unit_key", "yr", "biomes", None, value="biomes")

    recomputed = yearly_total(units, "yr", "area_total", "recomputed", EXACT, count_as=None)
    if published is not None:
        published = published.withColumnRenamed("area_total", "published")
    lost = units.groupBy("yr").agg(
        F.count_if(F.col("malformed_row").isNotNull()).alias("n_malformed"))
    totals = reconcile(recomputed, published, "yr", tol=1e-9).join(lost, "yr", "left").select(
        "yr", "recomputed", "published", "diff", "status",
        F.coalesce("n_malformed", F.lit(0)).alias("n_malformed"))
    return {"unit_year": unit_year_df, "unit_cells": cells, "cause_area": cause_area,
            "unit_dim": unit_dim, "biome_dim": biome_dim, "violations": violations,
            "totals": totals,
            "class_totals": class_totals_of(units), "fuzzy_matches": fuzzy_matches(units)}


def fuzzy_matches(units: DataFrame, max_dist: int = 2, size_tol: float = 0.01) -> DataFrame:
    """Candidate pairs of unit keys that may be one unit: same category and
    last key word, keys within ``max_dist`` edits, sizes within
    ``size_tol``.  Reported for review; never applied."""
    ent = units.select("category", F.element_at(F.split("unit_key", " "), -1).alias("last_word"),
                       "unit_key", "area_unit")
    return fuzzy_pairs(ent, "unit_key", "area_unit", ["category", "last_word"],
                       max_dist, size_tol)


def class_totals_of(units: DataFrame) -> DataFrame:
    """Prevention and combat subtotals recomputed from the cause columns,
    beside the published ones (where a layout has them)."""
    cause_of = {CAUSE_PREFIX + k: v for k, v in CAUSE_OF.items()}
    by_cause = {}
    for col, cause in cause_of.items():
        by_cause.setdefault(cause, []).append(col)
    wide = units.withColumns({c: component_sum(cols, EXACT) for c, cols in by_cause.items()})
    wide = class_totals(wide, decimal_type=EXACT)
    return wide.select("yr", "src_row", "unit", "prevention", "combat",
                       "prevention_published", "combat_published")
