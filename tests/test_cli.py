"""The command line on the fixture folder."""

import glob

from ashgrid.__main__ import main
from tests.fixtures import write_fixture


def test_build_writes_every_table(spark, tmp_path):
    src = write_fixture(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    assert main(["build", src, out]) == 0
    for name in ["unit_year", "unit_cells", "cause_area", "unit_dim", "biome_dim", "violations", "totals",
                 "class_totals", "fuzzy_matches"]:
        assert spark.read.parquet(f"{out}/{name}").count() > 0, name
    lines = open(glob.glob(f"{out}/totals_csv/*.csv")[0]).read().splitlines()
    assert lines[0] == "AREA_QUEIM_ANO,ano"
    assert [int(x.split(",")[1]) for x in lines[1:]] == [2023, 2022, 2021, 2020, 2018, 2015]


def test_totals_command(spark, tmp_path):
    src = write_fixture(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    assert main(["totals", src, out]) == 0
    lines = open(glob.glob(f"{out}/totals_csv/*.csv")[0]).read().splitlines()
    assert lines[0] == "AREA_QUEIM_ANO,ano"
    assert lines[1:] == ["32.0,2023", "27.001,2022", "40.0,2021", "34.5,2020", "77.0,2018", "79.0,2015"]
