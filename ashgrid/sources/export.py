"""Writing tables in the yearly layouts (the index column comes first).

Each layout group is one ``write.partitionBy("year").csv`` job into its own
``layout=Lx`` folder: the year lives only in the ``year=YYYY`` directory, as
it lives only in the file name of the published tables, and every output
file carries the layout's header.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.session import scratch_path
from ashgrid.sources.layouts import LAYOUTS, Layout

# Date format of the "last update" column by layout.
DATE_FORMAT = {"L1": "dd/MM/yyyy", "L2": "dd/MM/yyyy", "L3": "dd/MM/yyyy",
               "L4": "yyyy-MM-dd"}


def to_layout(df: DataFrame, layout: Layout | str, year: str = "yr") -> DataFrame:
    """Our columns -> the layout's columns as text, named as in its header,
    plus the partition column ``year``.  A column we do not have is empty."""
    if isinstance(layout, str):
        layout = LAYOUTS[layout]
    cols = []
    for h, c in zip(layout.header, layout.columns):
        if c == "last_update_raw":
            expr = F.date_format("last_update", DATE_FORMAT.get(layout.id, "yyyy-MM-dd"))
        elif c in df.columns:
            expr = F.col(c).cast("string")
        else:
            expr = F.lit(None).cast("string")
        cols.append(expr.alias(h))
    return df.select(*cols, F.col(year).cast("int").alias("year"))


def write_layout(df: DataFrame, path: str, layout: Layout | str, year: str = "yr",
                 mode: str = "append", index: str = "src_row") -> None:
    """Rows go out in index order inside each file: sorting each partition by
    (year, index) also satisfies the partitioned writer's own ordering on
    year, so Spark adds no second sort."""
    if index in df.columns:
        df = df.sortWithinPartitions(year, index)
    (to_layout(df, layout, year).write.mode(mode).partitionBy("year")
        .option("header", True).option("emptyValue", "").csv(path))


def write_indexed(df: DataFrame, path: str, order_by: list[str] | None = None,
                  index: str = "src_row", layout_col: str = "layout",
                  year: str = "yr") -> None:
    """Write each row in the layout named by ``layout_col``, the 0-based
    index within its year first.

    With ``order_by`` the index is computed here (``index_within``); without
    it ``df`` must carry ``index`` already.  The indexed rows are written once
    as parquet partitioned by layout, so each layout's job reads only its own
    rows, and is sorted again by (year, index): the part files of a year, in
    name order, list the rows in index order.  One write job per layout, into
    its own ``layout=Lx`` folder, so the jobs never share a committer's staging
    folder and run together; each job overwrites its folder, so a retried
    export replaces rather than doubles.
    """
    from ashgrid.operators.ordering import index_within
    spark = df.sparkSession
    if order_by is not None:
        df = index_within(df, year, order_by, index)
    staged = scratch_path(spark, "export")
    df.write.partitionBy(layout_col).parquet(staged)
    staged_rows = spark.read.schema(df.schema).parquet(staged)
    ids = [lid for lid in sorted(LAYOUTS) if lid != "LT"]
    # threads inherit the caller's job group and description, so the jobs
    # can be cancelled and traced with the query that started them
    @inheritable_thread_target(spark)
    def write_one(lid):
        own = staged_rows.where(F.col(layout_col) == F.lit(lid)).orderBy(year, index)
        write_layout(own, f"{path}/layout={lid}", lid, year, mode="overwrite", index=index)

    with ThreadPoolExecutor(max_workers=len(ids)) as pool:
        list(pool.map(write_one, ids))


def write_totals(df: DataFrame, path: str, value: str = "area_total", year: str = "yr") -> None:
    """Totals in the published layout, newest year first, one file."""
    from ashgrid.operators.metrics import as_totals_layout
    (as_totals_layout(df, value, year).coalesce(1).write.mode("overwrite")
        .option("header", True).csv(path))
