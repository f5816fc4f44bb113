"""The panel written as drifting yearly tables and read back.

The driver's tables have one schema; the yearly tables have six.  To run
the CSV operators (E1-E3, E12, R1-R6, R19) on data that grows with the
driver's tables, the unit-year panel is written in the six layouts (one
layout per year, by a fixed rule), published totals are written for 1998
on only, and everything is read back with layout detection.  The files go
below the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ashgrid.functions.numeric import component_sum, percent_of
from ashgrid.operators.metrics import yearly_total
from ashgrid.plans.panel import MONEY, unit_year_panel
from ashgrid.plans.yearly import conform_units, read_folder
from ashgrid.session import checkpoint_root, scratch_path
from ashgrid.sources.export import write_indexed, write_totals
from ashgrid.sources.layouts import CAUSE_PREFIX, LAYOUTS
from ashgrid.sources.yearly_csv import read_totals

FIRST_PUBLISHED_YEAR = 1998
ROUNDED_LAYOUTS = ("L5", "L6")


def layout_of_year(yr) -> F.Column:
    """Test-data rule (ours): which layout a panel year is written in."""
    return (F.when(yr <= 1996, "L1").when(yr == 1997, "L2").when(yr == 1998, "L3")
             .when(yr == 1999, "L4").when(yr == 2000, "L5").otherwise("L6"))


LAYOUT_SQL = ("case when yr <= 1996 then 'L1' when yr = 1997 then 'L2' when yr = 1998 then 'L3' "
              "when yr = 1999 then 'L4' when yr = 2000 then 'L5' else 'L6' end")


UNIT_ORDER = ["unit_raw", "unit"]


def panel_as_units(panel: DataFrame) -> DataFrame:
    """Panel columns under our yearly-table names (the index is added when
    the tables are written, see ``write_indexed``)."""
    def money_sum(*cols):
        return component_sum(list(cols), MONEY)

    zero = F.lit(0.0)
    df = panel.withColumn("layout", layout_of_year(F.col("yr")))
    pct = percent_of("area", "size")
    df = df.select(
        "yr", "layout", "unit",
        F.col("unit_name").alias("unit_raw"),
        F.col("seg").alias("biome_raw"),
        F.when(F.col("size") <= 0, F.lit("-")).otherwise(F.col("seg")).alias("mgmt_group_raw"),
        F.when(F.col("n_orders") > 1, F.lit("Landsat / Sentinel")).otherwise(F.lit("Modis"))
         .alias("sensor_raw"),
        "last_update",
        F.col("area").alias("area_total"),
        F.col("size").alias("area_unit"),
        F.when(F.col("layout").isin(*ROUNDED_LAYOUTS), percent_of("area", "size", 2))
         .otherwise(pct).alias("pct_published"),
        F.col("wildfire").alias(CAUSE_PREFIX + "Incendio"),
        money_sum("prescribed", "controlled", "firebreak", "natural").alias(CAUSE_PREFIX + "MIF"),
        F.col("natural").alias(CAUSE_PREFIX + "Fogo_natural"),
        F.col("prescribed").alias(CAUSE_PREFIX + "Queima_prescrita"),
        F.col("controlled").alias(CAUSE_PREFIX + "Queima_controlada"),
        F.col("firebreak").alias(CAUSE_PREFIX + "Aceiro_negro"),
        F.col("firebreak").alias(CAUSE_PREFIX + "Aceiro"),
        zero.alias(CAUSE_PREFIX + "Queima_indig_isol"),
        zero.alias(CAUSE_PREFIX + "Queima_indigena"),
        zero.alias(CAUSE_PREFIX + "Indigena_isolado"),
        zero.alias(CAUSE_PREFIX + "Gestao_raio"),
        zero.alias(CAUSE_PREFIX + "Raio"),
        money_sum("prescribed", "controlled", "firebreak").alias("prevention_published"),
        money_sum("wildfire", "natural").alias("combat_published"),
    )
    return df


def write_panel_tables(spark: SparkSession, sf_dir: str) -> str:
    """Write the tables of the folder as it is now; return their base path."""
    checkpoint_root(spark)
    base = scratch_path(spark, "yearly-tables")
    units = panel_as_units(unit_year_panel(spark, sf_dir)).checkpoint(eager=True)
    write_indexed(units, f"{base}/tables", order_by=UNIT_ORDER)
    totals = yearly_total(units, "yr", "area_total", "area_total", MONEY, count_as=None)
    write_totals(totals.where(F.col("yr") >= FIRST_PUBLISHED_YEAR), f"{base}/totals")
    return base


def write_malformed(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Beside the L6 tables, files of lines with a field too many or too few.

    One line for every panel row of 2001: its values shifted by an unquoted
    comma in the name, or, for rows of one order, without the last two fields.
    The lines are dealt out to several files, each with a header of its own.
    """
    rows = unit_year_panel(spark, sf_dir).where("yr = 2001")
    fields = ["unit", "unit_name", "seg", "area", "area", "area", "area", "area", "area", "area",
              "area", "area", "size", "size"]
    full = F.concat_ws(",", *(F.concat(F.lit("X,"), F.col(c)) if c == "unit_name"
                              else F.col(c).cast("string") for c in fields))
    short = F.concat_ws(",", *(F.col(c).cast("string") for c in fields[:-2]))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = rows.select(F.when(F.col("n_orders") > 1, full).otherwise(short).alias("line"),
                        F.lit(1).alias("n"), F.pmod(F.xxhash64("unit"), F.lit(files)).alias("file"))
    header = spark.range(files).select(F.lit(",".join(LAYOUTS["L6"].header)).alias("line"),
                                       F.lit(0).alias("n"), F.col("id").alias("file"))
    folder = f"{base}/tables/layout=L6-more/year=2001"
    (header.unionByName(lines).repartition("file").sortWithinPartitions("file", "n")
     .select("line", "file").write.partitionBy("file").text(folder))
    # Spark names text files .txt; the reader takes names that end in .csv
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.globStatus(hadoop.Path(f"{folder}/file=*/part-*")):
        path = status.getPath()
        system.rename(path, hadoop.Path(path.getParent(), path.getName().replace(".txt", ".csv")))


def read_back(spark: SparkSession, sf_dir: str, malformed: bool = False
              ) -> tuple[DataFrame, DataFrame]:
    """(yearly rows of all layouts, published totals), written and read again."""
    base = write_panel_tables(spark, sf_dir)
    if malformed:
        write_malformed(spark, sf_dir, base)
    rows, _ = read_folder(spark, f"{base}/tables")
    return rows, read_totals(spark, f"{base}/totals")


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read-back rows, cleaned and typed (``conform_units``)."""
    return conform_units(read_back(spark, sf_dir)[0])
