"""Registered queries: one per operator of the blueprint, each with the
DuckDB SQL that must give the same rows on the same parquet tables.

Every query reads whole tables (no key subsets, no row caps); a query's
work grows with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ashgrid.functions import (category, clean_text, null_if, parse_date, split_known,
                               split_values, unit_key)
from ashgrid.functions.numeric import exact_sum, percent_of
from ashgrid.operators.canonical import canonical
from ashgrid.operators.causes import (CAUSE_OF, cause_totals, class_totals,
                                      component_total, unpivot_causes)
from ashgrid.operators.collapse import collapse
from ashgrid.operators.fuzzy import fuzzy_pairs
from ashgrid.operators.history import asof_fill, change_flags, history
from ashgrid.operators.metrics import as_totals_layout, newest_first, yearly_total
from ashgrid.operators.multivalue import explode_values
from ashgrid.operators.ordering import index_within
from ashgrid.operators.quality import check, reconcile, with_group_stats
from ashgrid.plans import analyses, drift
from ashgrid.plans.entry import Entry
from ashgrid.plans.panel import MONEY, PANEL_CAUSES, PANEL_SQL, unit_year_panel
from ashgrid.plans.yearly import CAUSE_COLUMNS, EXACT, conform_units
from ashgrid.session import checkpoint_root, scratch_path
from ashgrid.sources.layouts import CAUSE_PREFIX
from ashgrid.sources.tables import read_table
from ashgrid.streaming.yearly_drop import ingest_available


def _panel_cte(body: str) -> str:
    return f"with panel as ({PANEL_SQL}) {body}"


# Checked outputs carry dates as ISO text, written the same way in both
# engines, so the comparison does not depend on how a client library
# renders a DATE (a date in one, a midnight timestamp in another).
def _iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def _iso_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


# ---------------------------------------------------------------- E items

def q_panel(spark, sf):
    return unit_year_panel(spark, sf).withColumn("last_update", _iso("last_update"))


SQL_PANEL = f"select * replace ({_iso_sql('last_update')} as last_update) from ({PANEL_SQL})"


def q_yearly_total(spark, sf):
    return newest_first(yearly_total(unit_year_panel(spark, sf), "yr", "area",
                                     "area_total", MONEY))


SQL_YEARLY_TOTAL = _panel_cte(
    "select yr, cast(sum(cast(area as decimal(18,2))) as double) as area_total, "
    "count(*) as n_rows from panel group by yr order by yr desc")


def q_totals_layout(spark, sf):
    return as_totals_layout(yearly_total(unit_year_panel(spark, sf), "yr", "area",
                                         "area_total", MONEY, count_as=None))


SQL_TOTALS_LAYOUT = _panel_cte(
    "select cast(sum(cast(area as decimal(18,2))) as double) as AREA_QUEIM_ANO, "
    "yr as ano from panel group by yr order by yr desc")


def q_percent_of_size(spark, sf):
    return (unit_year_panel(spark, sf)
            .select("unit", "yr", "area", "size", percent_of("area", "size").alias("pct")))


SQL_PERCENT_OF_SIZE = _panel_cte(
    "select unit, yr, area, size, case when size > 0 then 100 * area / size end as pct "
    "from panel")


def q_percent_rounded(spark, sf):
    return (unit_year_panel(spark, sf)
            .select("unit", "yr", percent_of("area", "size", scale=2).alias("pct2")))


SQL_PERCENT_ROUNDED = _panel_cte(
    "select unit, yr, cast(round(cast(case when size > 0 then 100 * area / size end "
    "as decimal(38,12)), 2) as double) as pct2 from panel")


def q_component_total(spark, sf):
    df = component_total(unit_year_panel(spark, sf), list(PANEL_CAUSES), "causes_total", MONEY)
    return df.select("unit", "yr", "area", "causes_total",
                     (F.col("area") - F.col("causes_total")).alias("gap"))


_CAUSE_SUM = " + ".join(f'cast("{c}" as decimal(18,2))' for c in PANEL_CAUSES)
SQL_COMPONENT_TOTAL = _panel_cte(
    f"select unit, yr, area, cast({_CAUSE_SUM} as double) as causes_total, "
    f"area - cast({_CAUSE_SUM} as double) as gap from panel")


def q_class_totals(spark, sf):
    return (class_totals(unit_year_panel(spark, sf), decimal_type=MONEY)
            .select("unit", "yr", "prevention", "combat"))


SQL_CLASS_TOTALS = _panel_cte(
    "select unit, yr, cast(cast(prescribed as decimal(18,2)) + cast(controlled as decimal(18,2)) "
    "+ cast(firebreak as decimal(18,2)) as double) as prevention, "
    "cast(cast(wildfire as decimal(18,2)) + cast(\"natural\" as decimal(18,2)) as double) as combat "
    "from panel")


def q_indexed_units(spark, sf):
    df = unit_year_panel(spark, sf).select("yr", "unit", "unit_name")
    return index_within(df, "yr", ["unit_name", "unit"], "ind").select("yr", "ind", "unit", "unit_name")


SQL_INDEXED_UNITS = _panel_cte(
    "select yr, row_number() over (partition by yr order by unit_name, unit) - 1 as ind, "
    "unit, unit_name from panel")


# ---------------------------------------------------------------- R items

def q_date_parse(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    text = F.when(F.year("o_orderdate") < 1998, F.date_format("o_orderdate", "dd/MM/yyyy")) \
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", _iso(parse_date(text)).alias("d"))


SQL_DATE_PARSE = f"select o_orderkey, {_iso_sql('cast(o_orderdate as date)')} as d from orders"


def q_text_clean(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit(" ** "))
    return p.select("p_partkey", clean_text(raw).alias("name"))


SQL_TEXT_CLEAN = ("select p_partkey, nullif(trim(regexp_replace(p_name, '\\s+', ' ', 'g')), '') "
                  "as name from part")

# Test-data mapping (ours): order status codes to words; 'P' is unmapped
# and passes through unchanged.
STATUS_WORDS = {"F": "FINISHED", "O": "OPEN"}


def q_canonical_map(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    return canonical(o, "o_orderstatus", STATUS_WORDS, out="status").select("o_orderkey", "status")


SQL_CANONICAL_MAP = (
    "select o_orderkey, coalesce(case o_orderstatus when 'F' then 'FINISHED' "
    "when 'O' then 'OPEN' end, o_orderstatus) as status from orders")


def q_causes_long(spark, sf):
    long = unpivot_causes(unit_year_panel(spark, sf), ["unit", "yr"], list(PANEL_CAUSES))
    return cause_totals(long, ["yr"], decimal_type=MONEY)


SQL_CAUSES_LONG = _panel_cte(
    "select yr, cause, cast(sum(cast(area as decimal(18,2))) as double) as area from ("
    + " union all ".join(f"select yr, '{c}' as cause, \"{c}\" as area from panel where \"{c}\" is not null"
                         for c in PANEL_CAUSES)
    + ") group by yr, cause")


def q_split_explode(spark, sf):
    p = read_table(spark, sf, "part", ["p_name"])
    words = p.select(F.explode(split_values("p_name", r"\s+")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


SQL_SPLIT_EXPLODE = (
    "select word, count(*) as n from (select unnest(string_split_regex(trim(p_name), '\\s+')) "
    "as word from part where p_name is not null) where word <> '' group by word")


def q_null_sentinel(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    return o.select("o_orderkey", null_if("o_orderstatus", "P").alias("status"))


SQL_NULL_SENTINEL = "select o_orderkey, nullif(trim(o_orderstatus), 'P') as status from orders"


def q_collapse_keys(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_suppkey", "l_shipdate", "l_quantity", "l_linestatus"])
    li = li.select("l_suppkey", F.year("l_shipdate").cast("int").alias("yr"),
                   F.col("l_quantity").alias("qty"), F.to_date("l_shipdate").alias("last_update"),
                   F.col("l_linestatus").alias("sensors"))
    return collapse(li, ["l_suppkey", "yr"], sum_cols=["qty"], max_cols=["last_update"],
                    set_cols={"sensors": "/"}, decimal_type=MONEY) \
        .withColumn("last_update", _iso("last_update"))


SQL_COLLAPSE_KEYS = (
    "select l_suppkey, cast(year(l_shipdate) as int) as yr, "
    "cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty, "
    f"{_iso_sql('max(cast(l_shipdate as date))')} as last_update, "
    "array_to_string(list_sort(list_distinct(list(l_linestatus))), '/') as sensors, "
    "count(*) as n_rows from lineitem group by l_suppkey, year(l_shipdate)")


def q_category_prefix(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    return p.select("p_partkey", category("p_name").alias("category"))


SQL_CATEGORY_PREFIX = (
    "select p_partkey, nullif(split_part(trim(p_name), ' ', 1), '') as category from part")


def q_unit_key(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_brand"])
    raw = F.concat_ws(" do ", "p_name", "p_brand")
    return p.select("p_partkey", unit_key(raw).alias("unit_key"))


SQL_UNIT_KEY = (
    "select p_partkey, nullif(array_to_string(list_filter(string_split(trim(regexp_replace("
    "translate(upper(concat_ws(' do ', p_name, p_brand)), 'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ', "
    "'AAAAAEEEEIIIIOOOOOUUUUCN'), '[^A-Z0-9]+', ' ', 'g')), ' '), "
    "lambda x: x <> '' and x not in ('DE', 'DA', 'DO', 'DAS', 'DOS', 'E', 'RIO')), ' '), '') "
    "as unit_key from part")


def q_fuzzy_units(spark, sf):
    p = read_table(spark, sf, "part", ["p_name", "p_brand", "p_type", "p_retailprice"])
    return fuzzy_pairs(p, "p_name", "p_retailprice", ["p_type", "p_brand"], 2, 0.01)


SQL_FUZZY_UNITS = (
    "with e as (select distinct p_type, p_brand, p_name, cast(p_retailprice as double) as s "
    "from part where p_name is not null and p_retailprice > 0 "
    "and p_type is not null and p_brand is not null) "
    "select a.p_type, a.p_brand, a.p_name as name_a, b.p_name as name_b, a.s as size_a, "
    "b.s as size_b, cast(levenshtein(a.p_name, b.p_name) as integer) as dist "
    "from e a join e b on a.p_type = b.p_type and a.p_brand = b.p_brand and a.p_name < b.p_name "
    "where levenshtein(a.p_name, b.p_name) <= 2 "
    "and abs(a.s - b.s) < 0.01 * greatest(a.s, b.s)")


def q_asof_fill(spark, sf):
    df = unit_year_panel(spark, sf).select(
        "unit", "yr", F.when(F.col("yr") <= 1998, F.col("seg")).alias("seg_seen"))
    return asof_fill(df, "unit", "yr", "seg_seen", "seg_filled")


SQL_ASOF_FILL = _panel_cte(
    "select unit, yr, seg_seen, last_value(seg_seen ignore nulls) over (partition by unit "
    "order by yr rows between unbounded preceding and current row) as seg_filled from ("
    "select unit, yr, case when yr <= 1998 then seg end as seg_seen from panel)")


def q_history_flags(spark, sf):
    df = unit_year_panel(spark, sf).select("unit", "yr", "area")
    return change_flags(df, "unit", "yr", "area", 0.5)


# The opening value of a version depends on the version before: one step a row.
_FLAGS_CTE = (
    "n as (select unit, yr, area, row_number() over (partition by unit order by yr) as i from panel), "
    "f as (select unit, yr, area, i, area as opened, cast(case when area is null then 0 else 1 end "
    "as integer) as changed, cast(case when area is null then 0 else 1 end as integer) as version "
    "from n where i = 1 union all "
    "select unit, yr, area, i, case when moved then area else opened end as opened, "
    "cast(moved as integer) as changed, version + cast(moved as integer) as version from ("
    "select n.unit, n.yr, n.area, n.i, f.opened, f.version, n.area is not null and (f.opened is null "
    "or abs(n.area - f.opened) > 0.5 * abs(f.opened)) as moved "
    "from f join n on n.unit = f.unit and n.i = f.i + 1)) ")
_FLAGS_SQL = "select unit, yr, area, opened, changed, version from f"
SQL_HISTORY_FLAGS = f"with recursive panel as ({PANEL_SQL}), {_FLAGS_CTE} {_FLAGS_SQL}"


def q_history_versions(spark, sf):
    df = unit_year_panel(spark, sf).select("unit", "yr", "area")
    return history(df, "unit", "yr", "area", 0.5)


SQL_HISTORY_VERSIONS = (
    f"with recursive panel as ({PANEL_SQL}), {_FLAGS_CTE} "
    "select unit, version, any_value(opened) as value, min(yr) as valid_from, max(yr) as valid_to, "
    f"count(*) as n_rows from ({_FLAGS_SQL}) where version > 0 group by unit, version")


def panel_rules() -> dict:
    pct = percent_of("area", "size")
    return {
        "size_not_positive": F.col("size") <= 0,
        "pct_out_of_range": (pct < 0) | (pct > 100),
        "causes_mismatch": F.abs(F.col("area") - F.col("causes_total")) > F.lit(1e-6) * F.abs(F.col("area")),
        "date_outside_year": (F.year("last_update") < F.col("yr")) | (F.year("last_update") > F.col("yr") + 1),
        "duplicate_key": F.col("key_count") > 1,
        "size_far_from_median": F.abs(F.col("size") - F.col("size_median")) > F.lit(0.5) * F.abs(F.col("size_median")),
    }


def q_quality_violations(spark, sf):
    checkpoint_root(spark)
    # three uses of the panel: computed once
    df = component_total(unit_year_panel(spark, sf), list(PANEL_CAUSES), "causes_total",
                         MONEY).checkpoint(eager=True)
    df = with_group_stats(df, [(["unit", "yr"], [F.count(F.lit(1)).alias("key_count")]),
                               (["unit"], [F.median("size").alias("size_median")])])
    return check(df, panel_rules(), ["unit", "yr"])


SQL_QUALITY_VIOLATIONS = _panel_cte(
    "select rule, unit, yr from (select *, case when size > 0 then 100 * area / size end as pct, "
    f"cast({_CAUSE_SUM} as double) as causes_total, "
    "case when unit is not null and yr is not null then count(*) over (partition by unit, yr) end "
    "as key_count, case when unit is not null then median(size) over (partition by unit) end "
    "as size_median from panel) t, "
    "lateral (select unnest(["
    "case when size <= 0 then 'size_not_positive' end, "
    "case when pct < 0 or pct > 100 then 'pct_out_of_range' end, "
    "case when abs(area - causes_total) > 1e-6 * abs(area) then 'causes_mismatch' end, "
    "case when year(last_update) < yr or year(last_update) > yr + 1 then 'date_outside_year' end, "
    "case when key_count > 1 then 'duplicate_key' end, "
    "case when abs(size - size_median) > 0.5 * abs(size_median) then 'size_far_from_median' end"
    "]) as rule) r where rule is not null")


# ------------------------------------------- yearly CSV round trip (E1 E2)

def q_drift_roundtrip(spark, sf):
    u = drift.conformed(spark, sf)
    return u.select("yr", "src_row", "unit", F.col("biome_clean").alias("biome"), "mgmt_group",
                    F.array_join("sensors", "/").alias("sensors"), _iso("last_update").alias("last_update"),
                    "area_total",
                    "area_unit", "pct_published", "causes_total", "layout")


def _drift_cte(body: str) -> str:
    return _panel_cte(
        ", p as (select *, cast(row_number() over (partition by yr order by unit_name, unit) - 1 "
        f"as integer) as src_row, {drift.LAYOUT_SQL} as layout from panel) " + body)


_DATED = "layout in ('L1', 'L2', 'L3', 'L4')"
_PCT = "case when size > 0 then 100 * area / size end"
SQL_DRIFT_ROUNDTRIP = _drift_cte(
    f"select yr, src_row, unit_name as unit, case when {_DATED} then seg end as biome, "
    "case when layout = 'L6' and size > 0 then seg end as mgmt_group, "
    "case when layout in ('L2', 'L3', 'L4') then case when n_orders > 1 "
    "then 'Landsat/Sentinel' else 'Modis' end end as sensors, "
    f"case when {_DATED} then {_iso_sql('last_update')} end as last_update, "
    "area as area_total, size as area_unit, "
    f"case when layout in ('L5', 'L6') then cast(round(cast({_PCT} as decimal(38,12)), 2) "
    f"as double) else {_PCT} end as pct_published, "
    "case when layout in ('L1', 'L2') then null else area end as causes_total, layout from p")


def q_drift_cause_area(spark, sf):
    u = drift.conformed(spark, sf)
    long = unpivot_causes(u, ["yr"], list(CAUSE_COLUMNS),
                          {CAUSE_PREFIX + k: v for k, v in CAUSE_OF.items()})
    return long.groupBy("yr", "cause").agg(
        exact_sum("area", EXACT).alias("area"),
        F.count(F.lit(1)).alias("n_rows"))


def _cause_rows(layouts: str, pairs: list[tuple[str, str]]) -> str:
    return " union all ".join(
        f"select yr, '{cause}' as cause, {expr} as area from p where layout in ({layouts})"
        for cause, expr in pairs)


_REST = ('cast(cast(prescribed as decimal(18,2)) + cast(controlled as decimal(18,2)) + '
         'cast(firebreak as decimal(18,2)) + cast("natural" as decimal(18,2)) as double)')
_SPLIT = [("wildfire", "wildfire"), ("prescribed", "prescribed"), ("controlled", "controlled"),
          ("firebreak", "firebreak"), ("natural", '"natural"'), ("indigenous", "0.0")]
SQL_DRIFT_CAUSE_AREA = _drift_cte(
    "select yr, cause, cast(sum(cast(area as decimal(18,2))) as double) as area, "
    "count(*) as n_rows from ("
    + _cause_rows("'L3'", [("wildfire", "wildfire"), ("managed_unsplit", _REST)]) + " union all "
    + _cause_rows("'L4', 'L5', 'L6'", _SPLIT) + " union all "
    + _cause_rows("'L4', 'L5'", [("lightning", "0.0")])
    + ") group by yr, cause")


def q_drift_totals_reconcile(spark, sf):
    rows, published = drift.read_back(spark, sf)
    rec = yearly_total(conform_units(rows), "yr", "area_total", "recomputed", EXACT, count_as=None)
    return reconcile(rec, published.withColumnRenamed("area_total", "published"), "yr", tol=1e-9)


SQL_DRIFT_TOTALS_RECONCILE = _panel_cte(
    ", t as (select yr, cast(sum(cast(area as decimal(18,2))) as double) as recomputed "
    "from panel group by yr) "
    f"select yr, recomputed, case when yr >= {drift.FIRST_PUBLISHED_YEAR} then recomputed end "
    f"as published, case when yr >= {drift.FIRST_PUBLISHED_YEAR} then recomputed - recomputed end "
    f"as diff, case when yr >= {drift.FIRST_PUBLISHED_YEAR} then 'ok' else 'missing_published' "
    "end as status from t")


def q_sensor_area(spark, sf):
    u = drift.conformed(spark, sf).select("yr", "sensors", "area_total")
    ex = explode_values(u, "sensors", "sensor", ["area_total"], allocate="equal")
    return ex.groupBy("yr", "sensor").agg(
        exact_sum("area_total", EXACT).alias("area"),
        F.count(F.lit(1)).alias("n_rows"))


SQL_SENSOR_AREA = _drift_cte(
    "select yr, sensor, cast(sum(cast(a as decimal(38,12))) as double) as area, "
    "count(*) as n_rows from ("
    "select yr, 'Landsat' as sensor, area / 2 as a from p "
    "where layout in ('L2', 'L3', 'L4') and n_orders > 1 union all "
    "select yr, 'Sentinel' as sensor, area / 2 as a from p "
    "where layout in ('L2', 'L3', 'L4') and n_orders > 1 union all "
    "select yr, 'Modis' as sensor, area as a from p "
    "where layout in ('L2', 'L3', 'L4') and n_orders <= 1) group by yr, sensor")


# ------------------------------------ incremental ingest (streaming, P15)

def _streamed(spark, sf, **options):
    base = drift.write_panel_tables(spark, sf)
    u = ingest_available(spark, f"{base}/tables", scratch_path(spark, "ingest-sink"), **options)
    return u.select(F.col("yr").cast("int").alias("yr"), "src_row", "unit",
                    F.col("biome_clean").alias("biome"), "mgmt_group",
                    F.array_join("sensors", "/").alias("sensors"), _iso("last_update").alias("last_update"),
                    "area_total",
                    "area_unit", "pct_published", "causes_total", "layout")


def q_stream_ingest(spark, sf):
    return _streamed(spark, sf)


def q_stream_ingest_single(spark, sf):
    """One file a batch: the result is that of all files at once."""
    return _streamed(spark, sf, max_files_per_trigger=1)


# ------------------------ rules and statuses on data where every one fires

def q_drift_malformed(spark, sf):
    rows, _ = drift.read_back(spark, sf, malformed=True)
    bad = F.col("malformed_row").isNotNull()
    return conform_units(rows).groupBy("yr").agg(
        exact_sum("area_total", EXACT).alias("area_total"), F.count_if(bad).alias("n_malformed"),
        F.count_if(bad & F.coalesce("unit", F.col("area_total").cast("string")).isNotNull())
        .alias("n_malformed_with_values"))


SQL_DRIFT_MALFORMED = _panel_cte(
    "select yr, cast(sum(cast(area as decimal(18,2))) as double) as area_total, "
    "count(*) filter (where yr = 2001) as n_malformed, cast(0 as bigint) as n_malformed_with_values "
    "from panel group by yr")


def q_quality_lineitem(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_shipdate"])
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    keys = li.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("key_count"))
    df = (li.join(keys, ["l_orderkey", "l_suppkey"], "left")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    return check(df, {
        "duplicate_key": F.col("key_count") > 1,
        "causes_mismatch": F.abs(F.col("l_extendedprice") - F.lit(1500.0) * F.col("l_quantity"))
                           > F.lit(0.2) * F.col("l_extendedprice"),
        "date_outside_year": (F.year("l_shipdate") < F.year("o_orderdate"))
                             | (F.year("l_shipdate") > F.year("o_orderdate") + 1),
        "pct_out_of_range": F.lit(2000) * F.col("l_discount") > 100,
    }, ["l_orderkey", "l_linenumber"])


SQL_QUALITY_LINEITEM = (
    "select rule, l_orderkey, l_linenumber from (select *, count(*) over (partition by l_orderkey, "
    "l_suppkey) as key_count from lineitem) t join orders on l_orderkey = o_orderkey, lateral (select unnest(["
    "case when key_count > 1 then 'duplicate_key' end, "
    "case when abs(l_extendedprice - 1500.0::double * l_quantity) > 0.2::double * l_extendedprice "
    "then 'causes_mismatch' end, "
    "case when year(l_shipdate) < year(o_orderdate) or year(l_shipdate) > year(o_orderdate) + 1 "
    "then 'date_outside_year' end, "
    "case when 2000 * l_discount > 100 then 'pct_out_of_range' end]) as rule) r where rule is not null")


def q_reconcile_statuses(spark, sf):
    """Published totals that agree, differ, conflict and lack a year on either side."""
    rec = yearly_total(unit_year_panel(spark, sf), "yr", "area", "recomputed", MONEY, count_as=None)
    pub = rec.select("yr", F.when(F.col("yr") == 1995, F.col("recomputed") + 5)
                     .otherwise(F.col("recomputed")).alias("published")).where("yr <> 2000")
    late = pub.where("yr in (1996, 1997)").select(
        F.when(F.col("yr") == 1997, F.col("yr") + 1000).otherwise(F.col("yr")).alias("yr"),
        (F.col("published") + 1).alias("published"))
    return reconcile(rec, pub.unionByName(late).unionByName(pub.where("yr = 1998")), "yr", tol=1e-9)


SQL_RECONCILE_STATUSES = _panel_cte(
    ", t as (select yr, cast(sum(cast(area as decimal(18,2))) as double) as r from panel group by yr), "
    "p as (select yr, case when yr = 1995 then r + 5 else r end as p from t where yr <> 2000 "
    "union all select 2997, r + 1 from t where yr = 1997) "
    "select coalesce(t.yr, p.yr) as yr, r as recomputed, p as published, r - p as diff, "
    "case when t.yr = 1996 then 'conflict' when p is null then 'missing_published' "
    "when r is null then 'missing_recomputed' when t.yr = 1995 then 'mismatch' else 'ok' end as status "
    "from t full join p on t.yr = p.yr")


def q_canonical_table(spark, sf):
    """Names replaced through a mapping table that repeats its keys."""
    nation = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    mapping = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(
        "n_regionkey <> 2").select(F.col("n_name").alias("raw"), F.col("r_name").alias("canonical"))
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"]).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return canonical(cust, "n_name", mapping.unionByName(mapping), out="name").select(
        "c_custkey", "name")


SQL_CANONICAL_TABLE = (
    "select c_custkey, case when n_regionkey <> 2 then r_name else n_name end as name from customer "
    "join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")


def q_split_known(spark, sf):
    """Two known values in one text are split, an unknown one keeps it whole."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    known = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
    text = F.when(F.col("c_acctbal") > 0, F.concat("c_mktsegment", F.lit(" E BUILDING"))) \
            .otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", F.array_join(split_known(text, known), "|").alias("parts"))


SQL_SPLIT_KNOWN = (
    "select c_custkey, case when c_acctbal > 0 then c_mktsegment || case when c_mktsegment in "
    "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') then '|BUILDING' else ' E BUILDING' end "
    "else c_mktsegment end as parts from customer")


def q_asof_changes(spark, sf):
    """As-of fill of an attribute that changes over the years and is missing in odd ones."""
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"])
    seen = o.groupBy(F.col("o_custkey").alias("unit"), F.year("o_orderdate").cast("int").alias("yr")) \
        .agg(F.max("o_orderpriority").alias("p"))
    seen = seen.select("unit", "yr", F.when(F.col("yr") % 2 == 0, F.col("p")).alias("seen"))
    return asof_fill(seen, "unit", "yr", "seen", "filled")


SQL_ASOF_CHANGES = (
    "select unit, yr, seen, last_value(seen ignore nulls) over (partition by unit order by yr rows "
    "between unbounded preceding and current row) as filled from (select o_custkey as unit, "
    "cast(year(o_orderdate) as int) as yr, case when year(o_orderdate) % 2 = 0 then "
    "max(o_orderpriority) end as seen from orders group by o_custkey, year(o_orderdate))")


REGISTRY: dict[str, Entry] = {
    "panel": Entry("E5-E9 input", q_panel, SQL_PANEL),
    "yearly_total": Entry("E10 E11", q_yearly_total, SQL_YEARLY_TOTAL),
    "totals_layout": Entry("E12", q_totals_layout, SQL_TOTALS_LAYOUT),
    "percent_of_size": Entry("E5", q_percent_of_size, SQL_PERCENT_OF_SIZE),
    "percent_rounded": Entry("E6", q_percent_rounded, SQL_PERCENT_ROUNDED),
    "component_total": Entry("E7", q_component_total, SQL_COMPONENT_TOTAL),
    "class_totals": Entry("E8 E9", q_class_totals, SQL_CLASS_TOTALS),
    "indexed_units": Entry("E3 E4", q_indexed_units, SQL_INDEXED_UNITS),
    "date_parse": Entry("R6", q_date_parse, SQL_DATE_PARSE),
    "text_clean": Entry("R7", q_text_clean, SQL_TEXT_CLEAN),
    "canonical_map": Entry("R8", q_canonical_map, SQL_CANONICAL_MAP),
    "causes_long": Entry("R9", q_causes_long, SQL_CAUSES_LONG),
    "split_explode": Entry("R10", q_split_explode, SQL_SPLIT_EXPLODE),
    "null_sentinel": Entry("R11", q_null_sentinel, SQL_NULL_SENTINEL),
    "collapse_keys": Entry("R12", q_collapse_keys, SQL_COLLAPSE_KEYS),
    "category_prefix": Entry("R13", q_category_prefix, SQL_CATEGORY_PREFIX),
    "unit_key": Entry("R14", q_unit_key, SQL_UNIT_KEY),
    "fuzzy_units": Entry("R15", q_fuzzy_units, SQL_FUZZY_UNITS),
    "asof_fill": Entry("R16", q_asof_fill, SQL_ASOF_FILL),
    "history_flags": Entry("R17", q_history_flags, SQL_HISTORY_FLAGS),
    "history_versions": Entry("R17", q_history_versions, SQL_HISTORY_VERSIONS),
    "quality_violations": Entry("R18", q_quality_violations, SQL_QUALITY_VIOLATIONS),
    "drift_roundtrip": Entry("E1 E3 R1-R7 R10 R11", q_drift_roundtrip, SQL_DRIFT_ROUNDTRIP),
    "drift_cause_area": Entry("E1 R9", q_drift_cause_area, SQL_DRIFT_CAUSE_AREA),
    "drift_totals_reconcile": Entry("E2 E12 R19", q_drift_totals_reconcile,
                                    SQL_DRIFT_TOTALS_RECONCILE),
    "sensor_area": Entry("R10 (explode, equal allocation)", q_sensor_area, SQL_SENSOR_AREA),
    "stream_ingest": Entry("P15 (E1 R1-R7 incremental)", q_stream_ingest, SQL_DRIFT_ROUNDTRIP),
    "stream_ingest_single": Entry("P15 (one file a batch)", q_stream_ingest_single,
                                  SQL_DRIFT_ROUNDTRIP),
    "drift_malformed": Entry("E1 R18 (malformed rows)", q_drift_malformed, SQL_DRIFT_MALFORMED),
    "quality_lineitem": Entry("R18 (every rule fires)", q_quality_lineitem, SQL_QUALITY_LINEITEM),
    "reconcile_statuses": Entry("R19 (every status)", q_reconcile_statuses,
                                SQL_RECONCILE_STATUSES),
    "canonical_table": Entry("R8 (mapping table)", q_canonical_table, SQL_CANONICAL_TABLE),
    "split_known": Entry("R10 (known values)", q_split_known, SQL_SPLIT_KNOWN),
    "asof_changes": Entry("R16 (changing values)", q_asof_changes, SQL_ASOF_CHANGES),
    **analyses.REGISTRY,
}
