"""Registered analyses over the unit-year panel, each with its DuckDB SQL.

These are ordinary questions about the tables (the blueprint's P items):
extra work beside the operators that the yearly tables themselves need.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ashgrid.operators import ranking
from ashgrid.operators.pivoting import pivot_years, unpivot_years
from ashgrid.operators.prefix import concentration, concentration_curve
from ashgrid.operators.quantiles import (exact_quantiles, merge_sketches, quantile_sketches,
                                         rank_error, sketch_quantiles)
from ashgrid.operators.recurrence import last_year, moving, recurrence, streaks, yearly_change
from ashgrid.operators.subtotals import subtotals
from ashgrid.operators.turnover import turnover, turnover_totals
from ashgrid.plans.entry import Entry
from ashgrid.plans.panel import MONEY, PANEL_SQL, unit_year_panel
from ashgrid.sources.tables import read_table

PERCENTS = [10, 25, 50, 75, 90]
QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
#: Stated years of the pivot; the panel also holds others.
PIVOT_YEARS = [1996, 1997, 1998, 1999, 2000]


def _panel(body: str) -> str:
    return f"with panel as ({PANEL_SQL}) {body}"


def _money(expr: str) -> str:
    return f"cast(cast({expr} as decimal(38,2)) as double)"


_AREA = f"cast(area as {MONEY})"


# ------------------------------------------------------- P9 concentration

def q_concentration_members(spark, sf):
    """The smallest set of units that holds half of each year's area."""
    panel = unit_year_panel(spark, sf).select("yr", "unit", "area")
    return concentration(panel, "yr", "unit", "area", 50, MONEY)


_RAN = (f", r as (select yr, unit, area, {_AREA} as a, "
        "row_number() over w as place, sum(cast(area as decimal(18,2))) over w as running, "
        "sum(cast(area as decimal(18,2))) over (partition by yr) as total from panel where area > 0 "
        "window w as (partition by yr order by area desc, unit rows between unbounded preceding "
        "and current row)) ")
SQL_CONCENTRATION_MEMBERS = _panel(
    _RAN + f"select yr, unit, area, place, {_money('running')} as running, "
    f"{_money('total')} as total from r where (running - a) * 100 < total * 50")


def q_concentration_curve(spark, sf):
    panel = unit_year_panel(spark, sf).select("yr", "unit", "area")
    return concentration_curve(panel, "yr", "unit", "area", PERCENTS, MONEY)


SQL_CONCENTRATION_CURVE = _panel(
    _RAN + f", p as (select unnest({PERCENTS}) as percent), "
    "u as (select yr, count(*) as n_units from r group by yr) "
    f"select r.yr, percent, count(*) as n_members, any_value(n_units) as n_units, "
    f"{_money('max(running)')} as held, {_money('max(total)')} as total "
    "from r join p on (running - a) * 100 < total * percent join u on u.yr = r.yr "
    "group by r.yr, percent")


# ----------------------------------------------------------- P11 quantiles

def q_quantiles_by_year(spark, sf):
    panel = unit_year_panel(spark, sf).select("yr", "area")
    return exact_quantiles(panel, "yr", "area", QUANTILES)


_QS = f"(select unnest({QUANTILES}) as q)"


def _quantile_sql(group: str, value: str, source: str) -> str:
    each = ", ".join(f"[{q}, quantile_cont({value}, {q})]" for q in QUANTILES)
    return (f"select {group}, cast(x[1] as double) as q, n, x[2] as value from ("
            f"select {group}, count({value}) as n, unnest([{each}]) as x from {source} "
            f"group by {group}) where n > 0")


SQL_QUANTILES_BY_YEAR = _panel(_quantile_sql("yr", "area", "panel"))


def q_quantiles_lineitem(spark, sf):
    """Prices of all line items by status: two groups hold nearly all rows, one text is null."""
    li = read_table(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice"])
    return exact_quantiles(li.select(F.nullif("l_returnflag", F.lit("R")).alias("flag"),
                                     F.col("l_extendedprice").alias("price")),
                           "flag", "price", QUANTILES)


SQL_QUANTILES_LINEITEM = _quantile_sql(
    "flag", "price", "(select nullif(l_returnflag, 'R') as flag, l_extendedprice as price from lineitem)")


def q_quantile_sketch_error(spark, sf):
    """Sketches per year and segment, merged to years, against the values' exact ranks."""
    panel = unit_year_panel(spark, sf).select("yr", "seg", "area")
    fine = quantile_sketches(panel.select(F.struct("yr", "seg").alias("cell"), "area"),
                             "cell", "area")
    merged = merge_sketches(fine.select(F.col("cell.yr").alias("yr"), "n", "sketch"), "yr")
    said = sketch_quantiles(merged, "yr", QUANTILES).select(
        F.col("yr").alias("s_yr"), "q", "n", "value")
    ranks = (panel.join(said, panel["yr"] == said["s_yr"]).groupBy("yr", "q", "n").agg(
        F.count_if(F.col("area") < F.col("value")).alias("under"),
        F.count_if(F.col("area") <= F.col("value")).alias("upto")))
    place = F.col("q") * F.col("n")
    slack = F.lit(rank_error()) * F.col("n") + 1
    return ranks.select("yr", "q", "n", ((F.col("under") <= place + slack)
                                         & (F.col("upto") >= place - slack)).alias("within"))


SQL_QUANTILE_SKETCH_ERROR = _panel(
    f"select yr, cast(q as double) as q, count(*) as n, true as within from panel, {_QS} group by yr, q")


# ---------------------------------------------------------- P8 recurrence

def q_streaks(spark, sf):
    return streaks(unit_year_panel(spark, sf).where("area > 0"), "unit", "yr")


_RUNS = (", y as (select distinct unit, yr from panel where area > 0), "
         "i as (select unit, yr, yr - row_number() over (partition by unit order by yr) as island from y), "
         "runs as (select unit, min(yr) as first, max(yr) as last, count(*) as length from i "
         "group by unit, island) ")
SQL_STREAKS = _panel(
    _RUNS + "select unit, cast(row_number() over (partition by unit order by first) as integer) as run, "
    "first, last, length from runs")


def q_recurrence(spark, sf):
    return recurrence(unit_year_panel(spark, sf).where("area > 0"), "unit", "yr")


SQL_RECURRENCE = _panel(
    _RUNS + ", e as (select max(yr) as yr from y) "
    "select unit, cast(sum(length) as bigint) as n_years, count(*) as n_runs, min(first) as first_year, "
    "max(last) as last_year, max(length) as longest_run, "
    "cast(arg_min(first, -length * 10000 + first) as integer) as longest_from, "
    "max(case when last = e.yr then length else 0 end) as current_run, "
    "cast(max(last) - min(first) + 1 - sum(length) as bigint) as absent_between, "
    "e.yr - max(last) as absent_since from runs, e group by unit, e.yr")


# -------------------------------------------------- P4 year-on-year change

def q_yearly_change(spark, sf):
    """Areas below 100,000 of odd years are unknown, of even ones zero: null is not zero."""
    panel = unit_year_panel(spark, sf)
    small = F.col("area") < 100000
    rows = panel.select("unit", "yr", F.when(small & (F.col("yr") % 2 == 0), F.lit(0.0))
                        .when(~small, F.col("area")).alias("area"))
    return yearly_change(rows, "unit", "yr", "area", MONEY, until=last_year(panel, "yr"))


SQL_YEARLY_CHANGE = _panel(
    ", s as (select unit, yr, case when area < 100000 then case when yr % 2 = 0 then 0.0::double end "
    "else area end as area from panel), "
    "spans as (select unit, min(yr) as lo from panel group by unit), "
    "years as (select unit, cast(unnest(range(lo, (select max(yr) from panel) + 1)) as integer) as yr "
    "from spans), "
    "d as (select y.unit, y.yr, s.area, s.unit is not null as present from years y "
    "left join s on s.unit = y.unit and s.yr = y.yr), "
    "l as (select *, lag(area) over w as before, last_value(area ignore nulls) over p as known, "
    "last_value(case when area is not null then yr end ignore nulls) over p as known_year, "
    "row_number() over w as i from d window w as (partition by unit order by yr), "
    "p as (partition by unit order by yr rows between unbounded preceding and 1 preceding)) "
    "select unit, yr, area, present, before, known, known_year, "
    f"cast({_AREA} - cast(before as {MONEY}) as double) as change, "
    f"case when before <> 0 then 100 * cast({_AREA} - cast(before as {MONEY}) as double) / abs(before) end "
    "as change_pct, case when not present then 'gap' when area is null then 'unknown' "
    "when i = 1 then 'first' when before is null then 'back' when before = 0 and area = 0 then 'same' "
    "when before = 0 then 'from_zero' when area = 0 then 'to_zero' when area > before then 'up' "
    "when area < before then 'down' else 'same' end as kind from l")


# --------------------------------------------------------------- P1 top-k

def _top(method: str):
    def query(spark, sf):
        """Units with most orders in a year; many tie."""
        panel = unit_year_panel(spark, sf).select("yr", "seg", "unit", "n_orders")
        order = [F.col("n_orders").desc()] + ([F.col("unit")] if method == "row_number" else [])
        return ranking.top_k(panel, "yr", order, 5, method).withColumn("rank", F.col("rank").cast("long"))
    return query


def _top_sql(method: str) -> str:
    order = "n_orders desc" + (", unit" if method == "row_number" else "")
    return _panel("select yr, seg, unit, n_orders, rank from (select *, "
                  f"{method}() over (partition by yr order by {order}) as rank from panel) where rank <= 5")


# ----------------------------------------------------------- P2 subtotals

def _totals(sets):
    def query(spark, sf):
        """Totals by year, segment and size class; one segment is null."""
        panel = unit_year_panel(spark, sf)
        rows = panel.select(
            "yr", F.nullif("seg", F.lit("BUILDING")).alias("seg"),
            F.when(F.col("size") <= 0, "none").when(F.col("size") < 5000, "small")
             .otherwise("large").alias("class"), "area", "wildfire")
        return subtotals(rows, ["yr", "seg", "class"], ["area", "wildfire"], sets, MONEY)
    return query


SETS = [["yr", "seg"], ["class"], []]


def _totals_sql(expand: str) -> str:
    return _panel(
        ", s as (select yr, nullif(seg, 'BUILDING') as seg, case when size <= 0 then 'none' "
        "when size < 5000 then 'small' else 'large' end as class, area, wildfire from panel) "
        "select yr, seg, class, cast(grouping_id(yr, seg, class) as integer) as level, "
        f"{_money('sum(cast(area as decimal(18,2)))')} as area, "
        f"{_money('sum(cast(wildfire as decimal(18,2)))')} as wildfire, count(*) as n_rows from s "
        f"group by {expand}")


# ------------------------------------------------------ P5 moving figures

def q_moving_figures(spark, sf):
    panel = unit_year_panel(spark, sf).select("unit", "yr", "area")
    return moving(panel, "unit", "yr", "area", 3, MONEY)


_SUM = "cast(sum(cast(area as decimal(18,2))) over {0} as double)"
SQL_MOVING_FIGURES = _panel(
    f"select unit, yr, area, {_SUM.format('t')} as running_total, "
    f"count(area) over y as years_n, {_SUM.format('y')} / count(area) over y as years_mean, "
    f"count(area) over r as rows_n, {_SUM.format('r')} / count(area) over r as rows_mean from panel "
    "window t as (partition by unit order by yr rows between unbounded preceding and current row), "
    "y as (partition by unit order by yr range between 2 preceding and current row), "
    "r as (partition by unit order by yr rows between 2 preceding and current row)")


# ---------------------------------------------------- P7 entering, leaving

def _unit_years(spark, sf):
    orders = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"])
    return orders.select(F.col("o_custkey").alias("unit"), F.year("o_orderdate").cast("int").alias("yr"))


def q_turnover_units(spark, sf):
    return turnover(_unit_years(spark, sf), "unit", "yr", 1995, 2001)


_SIDES = ("with c as (select o_custkey as unit, cast(year(o_orderdate) as integer) as yr, count(*) as n "
          "from orders group by all), p as (select unnest(range(1996, 2002)) as yr), "
          "s as (select unit, cast(p.yr as integer) as yr, "
          "cast(coalesce(sum(n) filter (c.yr = p.yr - 1), 0) as bigint) as n_before, "
          "cast(coalesce(sum(n) filter (c.yr = p.yr), 0) as bigint) as n_now "
          "from c join p on c.yr = p.yr or c.yr = p.yr - 1 group by unit, p.yr) ")
SQL_TURNOVER_UNITS = _SIDES + (
    "select unit, yr, n_before, n_now, case when n_before = 0 then 'entered' when n_now = 0 then 'left' "
    "else 'stayed' end as status from s")


def q_turnover_totals(spark, sf):
    return turnover_totals(_unit_years(spark, sf), "unit", "yr", 1995, 2001)


SQL_TURNOVER_TOTALS = _SIDES + (
    "select yr, count(*) filter (n_before > 0 and n_now > 0) as stayed, "
    "count(*) filter (n_before = 0) as entered, count(*) filter (n_now = 0) as left_out, "
    "cast(sum(least(n_before, n_now)) as bigint) as rows_common, "
    "cast(sum(n_now - least(n_before, n_now)) as bigint) as rows_entered, "
    "cast(sum(n_before - least(n_before, n_now)) as bigint) as rows_left from s group by yr")


# ---------------------------------------------------------------- P6 pivot

def q_pivot_years(spark, sf):
    panel = unit_year_panel(spark, sf).select("unit", "yr", "area")
    return pivot_years(panel, "unit", "yr", "area", PIVOT_YEARS, decimal_type=MONEY)


def _year_sum(condition: str) -> str:
    return f"{_money(f'sum({_AREA}) filter ({condition})')}"


SQL_PIVOT_YEARS = _panel(
    "select unit, " + ", ".join(f"{_year_sum(f'yr = {y}')} as y{y}" for y in PIVOT_YEARS)
    + f", {_year_sum('yr not in (' + ', '.join(map(str, PIVOT_YEARS)) + ')')} as other "
    "from panel group by unit")


def q_pivot_back(spark, sf):
    """The pivot's inverse: every stated year's rows as they were."""
    return unpivot_years(q_pivot_years(spark, sf), "unit", PIVOT_YEARS, "area")


SQL_PIVOT_BACK = _panel(
    f"select unit, yr, area from panel where yr in ({', '.join(map(str, PIVOT_YEARS))})")


REGISTRY: dict[str, Entry] = {
    "concentration_members": Entry("P9", q_concentration_members, SQL_CONCENTRATION_MEMBERS),
    "concentration_curve": Entry("P9", q_concentration_curve, SQL_CONCENTRATION_CURVE),
    "quantiles_by_year": Entry("P11 (exact)", q_quantiles_by_year, SQL_QUANTILES_BY_YEAR),
    "quantiles_lineitem": Entry("P11 (exact, hot groups)", q_quantiles_lineitem,
                                SQL_QUANTILES_LINEITEM),
    "quantile_sketch_error": Entry("P11 (sketch)", q_quantile_sketch_error,
                                   SQL_QUANTILE_SKETCH_ERROR),
    "streaks": Entry("P8", q_streaks, SQL_STREAKS),
    "recurrence": Entry("P8", q_recurrence, SQL_RECURRENCE),
    "yearly_change": Entry("P4", q_yearly_change, SQL_YEARLY_CHANGE),
    "top_units_rank": Entry("P1", _top("rank"), _top_sql("rank")),
    "top_units_dense": Entry("P1", _top("dense_rank"), _top_sql("dense_rank")),
    "top_units_rows": Entry("P1", _top("row_number"), _top_sql("row_number")),
    "subtotals_rollup": Entry("P2", _totals("rollup"), _totals_sql("rollup (yr, seg, class)")),
    "subtotals_cube": Entry("P2", _totals("cube"), _totals_sql("cube (yr, seg, class)")),
    "subtotals_sets": Entry("P2", _totals(SETS), _totals_sql("grouping sets ((yr, seg), (class), ())")),
    "moving_figures": Entry("P5", q_moving_figures, SQL_MOVING_FIGURES),
    "turnover_units": Entry("P7", q_turnover_units, SQL_TURNOVER_UNITS),
    "turnover_totals": Entry("P7", q_turnover_totals, SQL_TURNOVER_TOTALS),
    "pivot_years": Entry("P6", q_pivot_years, SQL_PIVOT_YEARS),
    "pivot_back": Entry("P6", q_pivot_back, SQL_PIVOT_BACK),
}
