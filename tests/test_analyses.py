"""Analyses over the unit-year grain against brute force, with skew, ties and holes."""

import random
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashgrid.operators import quantiles as Q
from ashgrid.operators.pivoting import pivot_years, unpivot_years
from ashgrid.operators.prefix import concentration, concentration_curve, running_sum
from ashgrid.operators.ranking import top_k
from ashgrid.operators.recurrence import (every_year, last_year, moving, recurrence, streaks,
                                          yearly_change)
from ashgrid.operators.subtotals import grouping_sets, subtotals
from ashgrid.operators.turnover import turnover, turnover_totals
from ashgrid.plans.catalog import REGISTRY
from tests.conftest import SF_SMALL
from tests.test_plans import plan_of

PANEL = "unit string, yr int, area double"


def panel_rows(seed=1, units=60, hot=0):
    """Units with missing years, tied, zero, null and negative areas; one year may be hot."""
    rng = random.Random(seed)
    rows = [(f"u{u}", y, rng.choice([0.0, 5.0, 5.0, 12.25, -3.0, None, rng.randrange(10_000) / 100]))
            for u in range(units) for y in range(2000, 2009) if rng.random() < 0.6]
    return rows + [(f"h{i}", 2004, rng.randrange(100_000) / 100) for i in range(hot)]


def panel(spark, rows, parts=5):
    return spark.createDataFrame(rows, PANEL).repartition(parts)


# ------------------------------------------------------------ P9 concentration

def test_running_sum_equals_a_loop_with_a_hot_year(spark):
    rows = panel_rows(hot=3000)
    got = {}
    ran = running_sum(panel(spark, rows, 9), "yr", [F.col("area").desc(), F.col("unit")], "area")
    for r in ran.collect():
        got[r.yr, r.unit] = (r.place, round(r.before, 2), round(r.running, 2), round(r.total, 2))
    for y in range(2000, 2009):
        mine = sorted((r for r in rows if r[1] == y),
                      key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        total, upto = round(sum(r[2] or 0 for r in mine), 2), 0.0
        for place, (u, _, a) in enumerate(mine, 1):
            assert got.pop((y, u)) == (place, round(upto, 2), round(upto + (a or 0), 2), total)
            upto += a or 0
    assert not got


def test_a_hot_year_is_summed_in_many_tasks(spark):
    rows = panel(spark, panel_rows(units=5, hot=20_000), 9)
    ran = running_sum(rows, "yr", [F.col("area").desc(), F.col("unit")], "area")
    plan = plan_of(ran)
    assert "SinglePartition" not in plan and "MapIn" not in plan
    assert "Window" in plan and "hashpartitioning(__part" in plan      # a window a task's part


@pytest.mark.parametrize("percent", [1, 50, 99, 100])
def test_smallest_set_that_holds_a_share(spark, percent):
    rows = panel_rows(seed=percent, hot=400)
    got = {}
    for r in concentration(panel(spark, rows), "yr", "unit", "area", percent).collect():
        got.setdefault(r.yr, set()).add(r.unit)
    curve = {(r.yr, r.percent): r for r in concentration_curve(
        panel(spark, rows), "yr", "unit", "area", [percent]).collect()}
    for y in range(2000, 2009):
        mine = sorted(((u, a) for u, yy, a in rows if yy == y and (a or 0) > 0),
                      key=lambda r: (-r[1], r[0]))
        cents = [round(100 * a) for _, a in mine]
        n = next((k for k in range(len(mine) + 1) if 100 * sum(cents[:k]) >= percent * sum(cents)), 0)
        assert got.get(y, set()) == {u for u, _ in mine[:n]}
        if mine:
            assert (curve[y, percent].n_members, curve[y, percent].n_units) == (n, len(mine))
            assert curve[y, percent].held == pytest.approx(sum(cents[:n]) / 100)


def test_concentration_of_nothing(spark):
    rows = [("a", 2000, None), ("b", 2000, 0.0), ("c", 2000, -4.0)]
    assert concentration(panel(spark, rows), "yr", "unit", "area", 50).count() == 0
    assert concentration(panel(spark, []), "yr", "unit", "area", 50).count() == 0
    assert concentration_curve(panel(spark, []), "yr", "unit", "area", [50]).count() == 0


# --------------------------------------------------------------- P11 quantiles

QS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def value_rows(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.random(), lambda: rng.randrange(4) * 1.0, lambda: 7.0,
            lambda: rng.lognormvariate(0, 40), lambda: -rng.expovariate(1e-9)]
    rows = [(f"g{g}", make()) for g, make in enumerate(draw) for _ in range(rng.randrange(1, 900))]
    rows += [("one", 3.5), ("two", 1.0), ("two", 2.0), ("none", None), (None, 5.0), (None, 6.0),
             ("g0", None)]
    rows += [("hot", 42.0 if i % 3 else i / 7) for i in range(6000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_exact_quantiles_equal_sorting(spark, monkeypatch, broadcast):
    monkeypatch.setattr(Q, "BROADCAST_ROWS", broadcast)
    rows = value_rows(broadcast)
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {(r.k, r.q): (r.n, r.value) for r in Q.exact_quantiles(df, "k", "v", QS).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == {(k, q) for k in groups for q in QS}
    for k, values in groups.items():
        for q in QS:
            assert got[k, q] == (len(values), pytest.approx(np.quantile(values, q), rel=1e-12))
    assert Q.exact_quantiles(df.limit(0), "k", "v", QS).count() == 0


def test_no_values_of_a_group_are_listed(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "_saved", lambda df, name, save=Q._saved: (seen.append(plan_of(df)),
                                                                      save(df, name))[1])
    df = spark.createDataFrame(value_rows(3), "k string, v double")
    Q.exact_quantiles(df, "k", "v", QS).collect()
    assert seen and not any("collect_list" in p for p in seen)


@pytest.mark.parametrize("k", [50, 200])
def test_sketches_merge_within_their_bound(spark, k):
    rows = [(f"g{i % 3}", f"p{i % 7}", float((i * 7919) % 30_011)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k string, part string, v double").repartition(6)
    fine = Q.quantile_sketches(df.select(F.struct("k", "part").alias("cell"), "v"), "cell", "v", k)
    merged = Q.merge_sketches(fine.select("cell.k", "n", "sketch"), "k", k)
    for r in Q.sketch_quantiles(merged, "k", QS).collect():
        values = np.sort([v for g, _, v in rows if g == r.k])
        assert r.n == len(values)
        low, high = np.searchsorted(values, r.value, "left"), np.searchsorted(values, r.value, "right")
        slack = Q.rank_error(k) * len(values) + 1
        assert low - slack <= r.q * len(values) <= high + slack
    assert all(len(s) < 64 * k for s, in fine.select("sketch").collect())


# -------------------------------------------------------------- P8 recurrence

def runs_of(years):
    out = []
    for _, g in groupby(enumerate(sorted(set(years))), key=lambda p: p[1] - p[0]):
        ys = [y for _, y in g]
        out.append((ys[0], ys[-1], len(ys)))
    return out


def test_streaks_and_recurrence(spark):
    rows = panel_rows(seed=5)
    rows += [("all", y, 1.0) for y in range(2000, 2009)] + [("all", 2003, 2.0), ("gone", 2001, 1.0),
                                                            ("odd", 2000, 1.0), ("odd", None, 1.0)]
    df = panel(spark, rows)
    assert last_year(df, "yr") == 2008 and last_year(df.limit(0), "yr") is None
    got = sorted(tuple(r) for r in streaks(df, "unit", "yr").collect())
    by_unit = {u: [y for x, y, _ in rows if x == u and y is not None] for u, _, _ in rows}
    assert got == sorted((u, i, *run) for u, ys in by_unit.items() for i, run in enumerate(runs_of(ys), 1))
    for r in recurrence(df, "unit", "yr").collect():
        runs = runs_of(by_unit[r.unit])
        longest = max(runs, key=lambda x: (x[2], -x[0]))
        n = sum(x[2] for x in runs)
        assert tuple(r)[1:] == (n, len(runs), runs[0][0], runs[-1][1], longest[2], longest[0],
                                runs[-1][2] if runs[-1][1] == 2008 else 0,
                                runs[-1][1] - runs[0][0] + 1 - n, 2008 - runs[-1][1])


# ----------------------------------------------------- P4 year-on-year change

def test_missing_years_are_rows_and_null_is_not_zero(spark):
    rows = [("a", 2000, 10.0), ("a", 2003, 15.0), ("a", 2004, 0.0), ("a", 2005, 0.0), ("a", 2006, 4.0),
            ("a", 2007, None), ("a", 2008, 1.0), ("b", 2004, -2.0), ("b", 2005, -3.0)]
    got = [tuple(r) for r in yearly_change(panel(spark, rows), "unit", "yr", "area", until=2007)
           .orderBy("unit", "yr").collect()]
    assert got == [
        ("a", 2000, 10.0, True, None, None, None, None, None, "first"),
        ("a", 2001, None, False, 10.0, 10.0, 2000, None, None, "gap"),
        ("a", 2002, None, False, None, 10.0, 2000, None, None, "gap"),
        ("a", 2003, 15.0, True, None, 10.0, 2000, None, None, "back"),
        ("a", 2004, 0.0, True, 15.0, 15.0, 2003, -15.0, -100.0, "to_zero"),
        ("a", 2005, 0.0, True, 0.0, 0.0, 2004, 0.0, None, "same"),
        ("a", 2006, 4.0, True, 0.0, 0.0, 2005, 4.0, None, "from_zero"),
        ("a", 2007, None, True, 4.0, 4.0, 2006, None, None, "unknown"),
        ("a", 2008, 1.0, True, None, 4.0, 2006, None, None, "back"),
        ("b", 2004, -2.0, True, None, None, None, None, None, "first"),
        ("b", 2005, -3.0, True, -2.0, -2.0, 2004, -1.0, -50.0, "down"),
        ("b", 2006, None, False, -3.0, -3.0, 2005, None, None, "gap"),
        ("b", 2007, None, False, None, -3.0, 2005, None, None, "gap")]


def test_every_year_joins_nothing(spark):
    df = every_year(panel(spark, panel_rows()), "unit", "yr", ["area"])
    assert "Join" not in plan_of(df)
    years = {}
    for r in df.collect():
        years.setdefault(r.unit, []).append(r.yr)
    assert all(sorted(ys) == list(range(min(ys), max(ys) + 1)) for ys in years.values())


# -------------------------------------------------------------------- P1 top-k

def test_ties_by_each_method(spark):
    rows = panel_rows(seed=3, hot=500) + [(f"t{i}", 2004, 5000.0) for i in range(9)]
    df = panel(spark, [r for r in rows if r[2] is not None])
    for k in (1, 3, 20):
        for y in range(2000, 2009):
            mine = sorted((-a, u) for u, yy, a in rows if yy == y and a is not None)
            values = sorted({a for a, _ in mine})
            wants = {"rank": {u for a, u in mine if sum(b < a for b, _ in mine) < k},
                     "dense_rank": {u for a, u in mine if a in values[:k]},
                     "row_number": {u for _, u in mine[:k]}}
            for method, want in wants.items():
                order = [F.col("area").desc(), *([F.col("unit")] if method == "row_number" else [])]
                got = top_k(df.where(F.col("yr") == y), "yr", order, k, method).collect()
                assert {r.unit for r in got} == want
        if k == 3:
            break


@pytest.mark.parametrize("name", ["top_units_rank", "top_units_dense", "top_units_rows"])
def test_top_k_is_limited_before_the_exchange(spark, name):
    plan = plan_of(REGISTRY[name].run(spark, SF_SMALL))
    final, partial = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert final < plan.index("Exchange hashpartitioning(yr") < partial
    assert "Final" in plan[final:final + 200] and "Partial" in plan[partial:partial + 200]


# ---------------------------------------------------------------- P2 subtotals

def test_subtotals_tell_null_keys_from_totals(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.randrange(1000) / 100)
            for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(4)
    for kind, levels in (("rollup", {0, 1, 3}), ("cube", {0, 1, 2, 3}), ([["b"], []], {2, 3})):
        got = {(r.level, r.a, r.b): (round(r.v, 2), r.n_rows)
               for r in subtotals(df, ["a", "b"], ["v"], kind).collect()}
        want = {}
        for a, b, v in rows:
            for level in levels:
                key = (level, None if level & 2 else a, None if level & 1 else b)
                s, n = want.get(key, (0, 0))
                want[key] = (s + round(100 * v), n + 1)
        assert got == {k: (s / 100, n) for k, (s, n) in want.items()}
    assert grouping_sets(["a", "b"], "cube") == [["a", "b"], ["a"], ["b"], []]
    assert subtotals(df.limit(0), ["a", "b"], ["v"], "rollup").count() == 0


def test_rows_are_aggregated_before_they_are_expanded(spark):
    plan = plan_of(REGISTRY["subtotals_cube"].run(spark, SF_SMALL))
    assert plan.index("Expand") < plan.index("Exchange hashpartitioning(yr", plan.index("Expand"))


# ------------------------------------------------------------------ P5 moving

def test_frames_by_years_and_by_rows(spark):
    rows = panel_rows(seed=8)
    by = {}
    for u, y, a in rows:
        by.setdefault(u, []).append((y, a))
    for r in moving(panel(spark, rows), "unit", "yr", "area", 3).collect():
        mine = sorted((y, a) for y, a in by[r.unit] if y <= r.yr)
        sets = {"total": [a for _, a in mine], "years": [a for y, a in mine if y > r.yr - 3],
                "rows": [a for _, a in mine[-3:]]}
        known = {k: [a for a in v if a is not None] for k, v in sets.items()}
        assert (r.years_n, r.rows_n) == (len(known["years"]), len(known["rows"]))
        for out, vals, mean in ((r.running_total, known["total"], False), (r.years_mean, known["years"], True),
                                (r.rows_mean, known["rows"], True)):
            assert (out is None) == (not vals)
            if vals:
                assert out == pytest.approx(sum(vals) / (len(vals) if mean else 1))


# ---------------------------------------------------------------- P7 turnover

def test_turnover_equals_set_operations(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", "c", "d", None]), rng.choice([2000, 2001, 2003, 1990, None]))
            for _ in range(60)]
    df = spark.createDataFrame(rows, "u string, y int").repartition(3)
    totals = {r.y: r for r in turnover_totals(df, "u", "y", 2000, 2004).collect()}
    cells = {(r.y, r.u): (r.n_before, r.n_now, r.status)
             for r in turnover(df, "u", "y", 2000, 2004).collect()}
    for y in range(2001, 2005):
        before, now = (df.where(F.col("y") == x).select("u") for x in (y - 1, y))
        assert totals[y].rows_common == before.intersectAll(now).count()
        assert totals[y].rows_entered == now.exceptAll(before).count()
        assert totals[y].rows_left == before.exceptAll(now).count()
        assert totals[y].entered == now.subtract(before).count()
        assert totals[y].left_out == before.subtract(now).count()
        assert totals[y].stayed == before.intersect(now).count()
        a, b = (Counter(u for u, x in rows if x == z) for z in (y - 1, y))
        for u in a | b:
            status = "stayed" if a[u] and b[u] else "entered" if b[u] else "left"
            assert cells.pop((y, u)) == (a[u], b[u], status)
    assert not cells


def test_one_exchange_serves_all_pairs_of_years(spark):
    plan = plan_of(REGISTRY["turnover_units"].run(spark, SF_SMALL))
    assert plan.count("Exchange") == 2 and "Join" not in plan      # the counts, then the pairs


# ------------------------------------------------------------------- P6 pivot

def test_pivot_and_back(spark):
    rows = panel_rows(seed=10) + [("x", None, 7.0), ("u1", 2001, 2.5)]
    df = panel(spark, rows)
    years = [2001, 2003, 2004, 2050]
    wide = pivot_years(df, "unit", "yr", "area", years)
    assert wide.columns == ["unit", "y2001", "y2003", "y2004", "y2050", "other"]
    sums = {}
    for u, y, a in rows:
        if a is not None:
            key = (u, y if y in years else None)
            sums[key] = sums.get(key, 0) + round(100 * a)
    got = {r.unit: r for r in wide.collect()}
    assert set(got) == {u for u, _, _ in rows}
    for u, r in got.items():
        assert [r.y2001, r.y2003, r.y2004, r.y2050, r.other] == [
            None if (u, y) not in sums else sums[u, y] / 100 for y in (*years, None)]
    back = {(r.unit, r.yr): r.area for r in unpivot_years(wide, "unit", years, "area").collect()}
    assert back == {k: s / 100 for k, s in sums.items() if k[1] is not None}
