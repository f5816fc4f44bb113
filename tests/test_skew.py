"""One key holding a third of all rows: results stay whole and right."""

import random
import statistics


from ashgrid.operators.collapse import collapse
from ashgrid.operators.fuzzy import fuzzy_pairs
from ashgrid.operators.metrics import yearly_total
from pyspark.sql import functions as F

from ashgrid.operators.quality import with_group_stats


def skewed_rows(n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 == 0 else f"K{rnd.randrange(200)}"
        rows.append((key, 2015 + rnd.randrange(3), float(rnd.choice([100, 101, 250, 400])),
                     rnd.choice(["Modis", "Landsat"]), i))
    return rows


def test_key_count_and_median_with_a_hot_key(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, yr int, size double, sensor string, id int").repartition(6)
    out = with_group_stats(df, [(["k", "yr"], [F.count(F.lit(1)).alias("key_count")]),
                                (["k"], [F.median("size").alias("med")])])
    got = {r.id: (r.key_count, r.med) for r in out.collect()}
    assert len(got) == len(rows)
    for k, yr, size, _, i in rows:
        same = [r for r in rows if r[0] == k]
        assert got[i] == (sum(1 for r in same if r[1] == yr), statistics.median(r[2] for r in same))


def test_collapse_with_a_hot_key(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, yr int, size double, sensor string, id int").repartition(6)
    got = {(r.k, r.yr): r for r in collapse(df, ["k", "yr"], sum_cols=["size"],
                                            set_cols={"sensor": "/"}).collect()}
    for (k, yr), r in got.items():
        same = [x for x in rows if x[0] == k and x[1] == yr]
        assert r.n_rows == len(same) and r.size == sum(x[2] for x in same)
        assert r.sensor == "/".join(sorted({x[3] for x in same}))
    assert sum(r.n_rows for r in got.values()) == len(rows)


def test_yearly_total_with_a_hot_year(spark):
    rows = [(2019 if i % 3 == 0 else 2015 + i % 4, i / 100) for i in range(5000)]
    df = spark.createDataFrame(rows, "yr int, a double").repartition(7)
    got = {r.yr: r.t for r in yearly_total(df, "yr", "a", "t", "decimal(18,2)").collect()}
    for y in got:
        assert abs(got[y] - sum(a for yy, a in rows if yy == y)) < 1e-6


def test_fuzzy_with_a_hot_name(spark):
    rows = [("PARNA", "SERRA AZUL", 100.0)] * 1000 + [("PARNA", "SERRA AZUI", 100.5)] * 500 \
        + [("PARNA", "SERRA VERDE", 100.0)]
    df = spark.createDataFrame(rows, "cat string, name string, size double").repartition(4)
    got = sorted(tuple(r) for r in fuzzy_pairs(df, "name", "size", ["cat"]).collect())
    assert got == [("PARNA", "SERRA AZUI", "SERRA AZUL", 100.5, 100.0, 1)]


def test_fuzzy_with_one_name_at_many_sizes(spark):
    # 600 sizes of one name in one size bucket: the name is matched once,
    # and sizes pair only with the partner's sizes within tolerance
    rows = [("PARNA", "SERRA AZUL", 1000.0 + i / 100) for i in range(600)] \
        + [("PARNA", "SERRA AZUI", 1000.0), ("PARNA", "SERRA AZUL", 5000.0)]
    df = spark.createDataFrame(rows, "cat string, name string, size double").repartition(4)
    got = fuzzy_pairs(df, "name", "size", ["cat"]).collect()
    assert len(got) == 600
    assert {(r.name_a, r.name_b) for r in got} == {("SERRA AZUI", "SERRA AZUL")}
    assert all(r.size_b < 1010.0 for r in got)
