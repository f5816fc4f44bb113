"""Written yearly tables: header per layout, index contiguous and in order."""

import glob
from collections import defaultdict

from ashgrid.plans.drift import UNIT_ORDER, panel_as_units
from ashgrid.plans.panel import unit_year_panel
from ashgrid.sources.export import write_indexed
from ashgrid.sources.layouts import LAYOUTS
from tests.conftest import SF_SMALL


def test_indexed_export(spark, tmp_path):
    out = str(tmp_path / "tables")
    units = panel_as_units(unit_year_panel(spark, SF_SMALL)).repartition(5)
    write_indexed(units, out, order_by=UNIT_ORDER)
    write_indexed(units, out, order_by=UNIT_ORDER)  # a retry replaces, never doubles
    by_year = defaultdict(list)
    for f in sorted(glob.glob(f"{out}/layout=*/year=*/*.csv")):
        lid = f.split("layout=")[1].split("/")[0]
        year = int(f.split("year=")[1].split("/")[0])
        with open(f) as fh:
            lines = fh.read().splitlines()
        assert lines[0] == ",".join(LAYOUTS[lid].header)
        by_year[year].extend(line.split(",") for line in lines[1:])
    assert by_year
    for year, rows in by_year.items():
        assert [int(r[0]) for r in rows] == list(range(len(rows))), year
        names = [r[1] for r in rows]
        assert names == sorted(names), year
