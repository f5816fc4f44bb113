"""The unit-year panel built from the driver's tables.

The driver's tables stand in for the yearly burned-area tables: a customer
is a unit, the order year is the year, the order total is burned area, the
order priority is the cause, the account balance is the unit's size, the
market segment is its biome, and the order date is the "last update".

Plan: orders are aggregated to (customer, year) first, with a partial
aggregate before the shuffle, so a customer holding a third of all orders
crosses the network as one row per map task and year; only then is the
much smaller result joined to customer on the key.  Spark picks broadcast
or sort-merge for that join from the measured size of customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ashgrid.functions.numeric import exact_sum
from ashgrid.sources.tables import read_table

MONEY = "decimal(18,2)"

# Test-data mapping (ours, not from the yearly tables): order priority ->
# the cause column it plays in the panel.
PRIORITY_CAUSE = {
    "1-URGENT": "wildfire",
    "2-HIGH": "prescribed",
    "3-MEDIUM": "controlled",
    "4-NOT SPECIFIED": "firebreak",
    "5-LOW": "natural",
}
PANEL_CAUSES = tuple(PRIORITY_CAUSE.values())


def unit_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders",
                        ["o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    price = F.col("o_totalprice")
    aggs = [exact_sum(price, MONEY).alias("area")]
    aggs += [exact_sum(F.when(F.col("o_orderpriority") == F.lit(p), price).otherwise(F.lit(0.0)),
                       MONEY).alias(c) for p, c in PRIORITY_CAUSE.items()]
    aggs += [F.max(F.to_date("o_orderdate")).alias("last_update"),
             F.count(F.lit(1)).alias("n_orders")]
    cells = (orders.groupBy(F.col("o_custkey").alias("unit"),
                            F.year("o_orderdate").cast("int").alias("yr"))
                   .agg(*aggs))
    cust = read_table(spark, sf_dir, "customer",
                      ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    return (cells.join(cust, cells.unit == cust.c_custkey, "inner")
                 .select("unit", "yr", F.col("c_name").alias("unit_name"),
                         F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("size"),
                         "area", *PANEL_CAUSES, "last_update", "n_orders"))


def _money(expr: str) -> str:
    return f"cast({expr} as {MONEY})"


PANEL_SQL = (
    "select o_custkey as unit, cast(year(o_orderdate) as int) as yr, "
    "c_name as unit_name, c_mktsegment as seg, c_acctbal as size, "
    f"cast(sum({_money('o_totalprice')}) as double) as area, "
    + "".join(
        f"cast(sum(case when o_orderpriority = '{p}' then {_money('o_totalprice')} "
        f"else {_money('0')} end) as double) as \"{c}\", "
        for p, c in PRIORITY_CAUSE.items())
    + "max(cast(o_orderdate as date)) as last_update, count(*) as n_orders "
    "from orders join customer on o_custkey = c_custkey "
    "group by o_custkey, year(o_orderdate), c_name, c_mktsegment, c_acctbal"
)
