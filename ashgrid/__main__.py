"""Command line.

    python -m ashgrid build IN OUT   yearly tables under IN -> canonical tables under OUT
    python -m ashgrid totals IN OUT  yearly totals of IN in the published layout (CSV)

IN is a folder, a glob or a file; OUT is any path Spark can write.  Tables
are parquet, partitioned by year where they have one; the totals are also
written as a CSV in the published layout (value, year; newest first).
"""

from __future__ import annotations

import argparse
import os
import sys

from ashgrid.session import get_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ashgrid")
    ap.add_argument("command", choices=["build", "totals"])
    ap.add_argument("input")
    ap.add_argument("output")
    # spark-submit names the master itself
    ap.add_argument("--master", default=None if os.environ.get("SPARK_ENV_LOADED") else "local[*]",
                    help="Spark master, e.g. local[8]")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    from ashgrid.plans.yearly import EXACT, build, conform_units, read_folder
    from ashgrid.operators.metrics import yearly_total
    from ashgrid.sources.export import write_totals
    out = a.output.rstrip("/")
    if a.command == "totals":
        rows, _ = read_folder(spark, a.input)
        write_totals(yearly_total(conform_units(rows), "yr", "area_total", "area_total", EXACT,
                                  count_as=None), f"{out}/totals_csv")
        return 0
    tables = build(spark, a.input, units_table=f"{out}/units_conformed")
    by_year = {"unit_year", "unit_cells", "cause_area", "violations", "class_totals"}
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        (w.partitionBy("yr") if name in by_year else w).parquet(f"{out}/{name}")
    rec = spark.read.parquet(f"{out}/totals")
    write_totals(rec.withColumnRenamed("recomputed", "area_total"), f"{out}/totals_csv")
    return 0


if __name__ == "__main__":
    sys.exit(main())
