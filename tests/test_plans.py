"""Physical-plan checks for every registered query: the properties that
matter at scale, not only the rows."""

import pytest

from ashgrid.plans.catalog import REGISTRY
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(e.run(spark, SF_SMALL)) for n, e in REGISTRY.items()}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_and_no_all_pairs(plans, name):
    p = plans[name]
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_scans_read_only_needed_columns(plans, name):
    p = plans[name]
    if "orders.parquet" in p:
        assert "o_comment" not in p and "o_clerk" not in p
    if "lineitem.parquet" in p:
        # lineitem has 11 columns; only one query needs the prices
        priced = name == "quality_lineitem"
        for col in ("l_tax", "l_returnflag") + (() if priced else ("l_discount", "l_extendedprice")):
            assert col not in p, (name, col)


def test_panel_aggregates_before_the_shuffle(plans):
    p = plans["panel"]
    assert "partial_sum" in p and "partial_count" in p
    # the partial aggregate sits below the exchange on the orders side
    assert p.index("Exchange hashpartitioning(o_custkey") < p.rindex("partial_sum")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_nothing_funnels_into_one_task(plans, name):
    # an un-partitioned window or a global aggregate without keys would
    # move every row to a single partition
    assert "SinglePartition" not in plans[name], name


def test_quality_rules_scan_orders_once(plans):
    # the panel is computed before, once; its three uses read that
    assert "orders.parquet" not in plans["quality_violations"]


def test_export_reads_each_layout_alone(spark, tmp_path):
    from ashgrid.plans.drift import panel_as_units
    from ashgrid.plans.panel import unit_year_panel
    df = panel_as_units(unit_year_panel(spark, SF_SMALL))
    df.write.partitionBy("layout").parquet(f"{tmp_path}/staged")
    one = spark.read.schema(df.schema).parquet(f"{tmp_path}/staged").where("layout = 'L2'")
    assert "PartitionFilters: [isnotnull(layout" in plan_of(one)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_arrow_passes_for_versions_only(plans, name):
    assert ("MapInArrow" in plans[name]) == (name in ("history_flags", "history_versions"))
    if name.startswith("history"):
        assert "collect_list" not in plans[name]


def test_malformed_lines_are_dealt_out(spark):
    from ashgrid.plans.drift import write_malformed
    from ashgrid.session import scratch_path
    base = scratch_path(spark, "malformed")
    write_malformed(spark, SF_SMALL, base)
    files = (spark.read.option("recursiveFileLookup", "true").text(base)
             .selectExpr("_metadata.file_path as f", "value"))
    by_file = {}
    for r in files.collect():
        by_file.setdefault(r.f, []).append(r.value)
    assert len(by_file) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(lines[0].startswith("ind,") and f.endswith(".csv") for f, lines in by_file.items())
