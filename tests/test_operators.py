"""Operators against brute force on small inputs."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ashgrid.operators.canonical import canonical
from ashgrid.operators.causes import class_totals, unpivot_causes
from ashgrid.operators.collapse import collapse
from ashgrid.operators.fuzzy import fuzzy_pairs
from ashgrid.operators.history import asof_fill, change_flags, history
from ashgrid.operators.metrics import as_totals_layout, yearly_total
from ashgrid.operators.ordering import index_within
from ashgrid.operators.quality import check, reconcile


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_index_within_matches_row_number_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [(2019 if i % 3 == 0 else rnd.choice([2015, 2016, 2017]), f"U{rnd.randrange(10**6):06d}", i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "yr int, unit string, id int").repartition(7)
    got = {r.id: r.ind for r in index_within(df, "yr", ["unit", "id"], "ind").collect()}
    expect = {}
    for y in {r[0] for r in rows}:
        for k, r in enumerate(sorted((r for r in rows if r[0] == y), key=lambda r: (r[1], r[2]))):
            expect[r[2]] = k
    assert got == expect


def test_index_within_shuffled_offsets_branch(spark):
    rows = [(y, f"u{i:04d}") for i, y in enumerate([2015, 2016, 2016, None] * 50)]
    df = spark.createDataFrame(rows, "yr int, u string").repartition(5)
    a = {(r.yr, r.u): r.ind for r in index_within(df, "yr", ["u"]).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = {(r.yr, r.u): r.ind for r in index_within(df, "yr", ["u"]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b and sorted(v for (y, _), v in a.items() if y == 2016) == list(range(100))


def test_index_within_null_group(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, "c")], "g int, u string")
    got = {(r.g, r.u): r.ind for r in index_within(df, "g", ["u"]).collect()}
    assert got == {(None, "a"): 0, (None, "b"): 1, (1, "c"): 0}


def test_yearly_total_counts_every_row(spark):
    df = spark.createDataFrame([(2019, 1.1), (2019, 1.1), (2020, 0.1), (2020, 0.2)], "yr int, a double")
    got = {r.yr: (r.t, r.n_rows) for r in yearly_total(df, "yr", "a", "t").collect()}
    assert got == {2019: (2.2, 2), 2020: (0.3, 2)}
    lay = as_totals_layout(yearly_total(df, "yr", "a", "area_total", count_as=None))
    assert lay.columns == ["AREA_QUEIM_ANO", "ano"]
    assert [r.ano for r in lay.collect()] == [2020, 2019]


def test_unpivot_drops_null_keeps_zero(spark):
    df = spark.createDataFrame([(1, None, None), (2, 6.0, None), (3, 0.0, 0.0)],
                               "id int, Incendio double, MIF double")
    got = sorted(tuple(r) for r in unpivot_causes(
        df, ["id"], ["Incendio", "MIF"], {"Incendio": "wildfire", "MIF": "managed_unsplit"}).collect())
    assert got == [(2, "Incendio", "wildfire", 6.0), (3, "Incendio", "wildfire", 0.0),
                   (3, "MIF", "managed_unsplit", 0.0)]


def test_class_totals(spark):
    df = spark.createDataFrame([(3.0, 1.0, 1.0, 0.0, 2.0)],
                               "wildfire double, prescribed double, controlled double, "
                               "firebreak double, natural double")
    r = class_totals(df, decimal_type="decimal(18,2)").first()
    assert (r.prevention, r.combat) == (2.0, 5.0)


def test_canonical_dict_and_frame(spark):
    df = spark.createDataFrame([("MATA ATANTICA",), ("CERRADO",), (None,)], "b string")
    m = {"MATA ATANTICA": "MATA ATLANTICA"}
    assert [r.b for r in canonical(df, "b", m).collect()] == ["MATA ATLANTICA", "CERRADO", None]
    mdf = spark.createDataFrame([("MATA ATANTICA", "MATA ATLANTICA")], "raw string, canonical string")
    assert sorted(r.b or "" for r in canonical(df, "b", mdf).collect()) == ["", "CERRADO", "MATA ATLANTICA"]


def test_collapse_keeps_provenance(spark):
    df = spark.createDataFrame([
        Row(k="A", yr=2019, a=1.5, s=["Modis"], d="2019-01-01"),
        Row(k="A", yr=2019, a=2.5, s=["Landsat", "Sentinel"], d="2029-11-05"),
        Row(k="B", yr=2019, a=1.0, s=["Modis"], d="2019-02-02")])
    got = {r.k: r for r in collapse(df, ["k", "yr"], ["a"], ["d"], array_cols=["s"]).collect()}
    assert got["A"].a == 4.0 and got["A"].n_rows == 2 and got["A"].d == "2029-11-05"
    assert got["A"].s == ["Landsat", "Modis", "Sentinel"]
    assert got["B"].n_rows == 1


def test_asof_fill_never_looks_ahead(spark):
    df = spark.createDataFrame([("u", 2015, None), ("u", 2016, "CERRADO"), ("u", 2017, None),
                                ("v", 2017, None)], "k string, yr int, b string")
    got = {(r.k, r.yr): r.f for r in asof_fill(df, "k", "yr", "b", "f").collect()}
    assert got == {("u", 2015): None, ("u", 2016): "CERRADO", ("u", 2017): "CERRADO",
                   ("v", 2017): None}


def test_history_versions(spark):
    df = spark.createDataFrame([("u", 2016, 50000.25), ("u", 2017, 200000.75), ("u", 2018, 200000.5),
                                ("u", 2019, 200000.75)], "k string, yr int, s double")
    flags = {r.yr: (r.changed, r.version) for r in change_flags(df, "k", "yr", "s", 0.01).collect()}
    assert flags == {2016: (1, 1), 2017: (1, 2), 2018: (0, 2), 2019: (0, 2)}
    h = sorted(tuple(r) for r in history(df, "k", "yr", "s", 0.01).collect())
    assert h == [("u", 1, 50000.25, 2016, 2016, 1), ("u", 2, 200000.75, 2017, 2019, 3)]


def test_explode_values_allocation(spark):
    from ashgrid.operators.multivalue import explode_values
    df = spark.createDataFrame([(["Landsat", "Sentinel"], 10.0), (["Modis"], 4.0), ([], 1.0), (None, 2.0)],
                               "s array<string>, a double")
    eq = sorted(tuple(r) for r in explode_values(df, "s", "sensor", ["a"], "equal").select("sensor", "a").collect())
    assert eq == [("Landsat", 5.0), ("Modis", 4.0), ("Sentinel", 5.0)]
    none = sorted(tuple(r) for r in explode_values(df, "s", "sensor").select("sensor", "a").collect())
    assert none == [("Landsat", 10.0), ("Modis", 4.0), ("Sentinel", 10.0)]


def test_history_of_text_with_missing_years(spark):
    df = spark.createDataFrame([("u", 2015, None), ("u", 2016, "CAATINGA"), ("u", 2017, None),
                                ("u", 2018, "CAATINGA"), ("u", 2019, "CERRADO")],
                               "k string, yr int, b string")
    h = sorted(tuple(r) for r in history(df, "k", "yr", "b", None).collect())
    assert h == [("u", 1, "CAATINGA", 2016, 2018, 3), ("u", 2, "CERRADO", 2019, 2019, 1)]


def test_check_one_row_per_broken_rule(spark):
    df = spark.createDataFrame([(1, -1.0, 150.0), (2, 5.0, 50.0), (3, 0.0, None)],
                               "id int, size double, pct double")
    rules = {"size_not_positive": F.col("size") <= 0, "pct_over_100": F.col("pct") > 100}
    got = sorted(tuple(r) for r in check(df, rules, ["id"]).collect())
    assert got == [("pct_over_100", 1), ("size_not_positive", 1), ("size_not_positive", 3)]


def test_reconcile_reports_both_missing_sides(spark):
    rec = spark.createDataFrame([(2017, 10.0), (2018, 5.0), (2019, 7.0)], "yr int, recomputed double")
    pub = spark.createDataFrame([(2018, 5.0 + 1e-12), (2019, 8.0), (2020, 1.0)], "yr int, published double")
    got = {r.yr: r.status for r in reconcile(rec, pub, "yr").collect()}
    assert got == {2017: "missing_published", 2018: "ok", 2019: "mismatch", 2020: "missing_recomputed"}


def brute_pairs(rows, tau, tol):
    ents = sorted(set(rows))
    out = set()
    for i, a in enumerate(ents):
        for b in ents[i + 1:]:
            if a[0] != b[0] or a[1] == b[1] or not (a[2] > 0 and b[2] > 0):
                continue
            d = lev(a[1], b[1])
            if d <= tau and abs(a[2] - b[2]) < tol * max(a[2], b[2]):
                x, y = (a, b) if a[1] < b[1] else (b, a)
                out.add((a[0], x[1], y[1], x[2], y[2], d))
    return out


@pytest.mark.parametrize("seed,tau", [(1, 2), (2, 1), (3, 2), (4, 3), (5, 2), (6, 3), (7, 1), (8, 2)])
def test_fuzzy_pairs_equal_brute_force(spark, seed, tau):
    rnd = random.Random(seed)
    base = ["CAMPLANA SUL", "TAIM", "TAIAMA", "SERRA CIPO", "AB", "A", "", "CHAPADA VEADEIROS"]
    rows = []
    for _ in range(300):
        w = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            op, pos = rnd.randrange(3), rnd.randrange(len(w) + 1)
            if op == 0:
                w.insert(pos, rnd.choice("ABI "))
            elif op == 1 and pos < len(w):
                del w[pos]
            elif pos < len(w):
                w[pos] = rnd.choice("ABI ")
        size = rnd.choice([100.0, 100.5, 101.0, 103.0, 99.2, 0.0, 250.0])
        rows.append((rnd.choice(["PARNA", "ESEC"]), "".join(w), size))
    df = spark.createDataFrame(rows, "cat string, name string, size double")
    got = {tuple(r) for r in fuzzy_pairs(df, "name", "size", ["cat"], tau, 0.01).collect()}
    assert got == brute_pairs(rows, tau, 0.01)


def test_rule_tags(spark):
    from ashgrid.operators.quality import dq_tags
    df = spark.createDataFrame([("b", 4.0), ("a", 0.0)], "unit string, size double")
    tags = {r.unit: r.dq for r in dq_tags(df, {"no_size": F.col("size") <= 0}).collect()}
    assert tags == {"b": [], "a": ["no_size"]}


def test_mapping_table_never_multiplies_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("x",)], "v string")
    mapping = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B")], "raw string, canonical string")
    assert sorted(r.v for r in canonical(df, "v", mapping).collect()) == ["A", "A", "x"]
    two = spark.createDataFrame([("a", "A"), ("a", "B")], "raw string, canonical string")
    with pytest.raises(Exception, match="two values"):
        canonical(df, "v", two).collect()


def test_collapse_takes_attributes_from_one_row(spark):
    df = spark.createDataFrame([("k", "a", 9, "f1", 1), ("k", "b", 1, "f2", 7), ("k", None, 20, "f2", 8)],
                               "k string, name string, grp int, file string, n int")
    row = collapse(df, ["k"], row_cols=["name", "grp"], sources=["file", "n"]).first()
    assert (row.name, row.grp) == ("b", 1)
    assert [tuple(x) for x in row.sources] == [("f1", 1), ("f2", 7), ("f2", 8)]


def test_slow_drift_opens_a_version(spark):
    df = spark.createDataFrame([("u", 1980 + i, 100 * 1.009 ** i) for i in range(40)],
                               "k string, yr int, v double")
    versions = history(df, "k", "yr", "v", 0.01).orderBy("version").collect()
    assert len(versions) == 20 and versions[-1].value > 130
    assert [(r.valid_from, r.valid_to) for r in versions][:2] == [(1980, 1981), (1982, 1983)]


def test_reconcile_every_status(spark):
    rec = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0), (4, 8.0)], "yr int, recomputed double")
    pub = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 9.0), (3, 7.0), (3, 8.0), (9, 1.0), (None, 2.0)],
                                "yr int, published double")
    got = {r.yr: r.status for r in reconcile(rec, pub, "yr").collect()}
    assert got == {1: "ok", 2: "mismatch", 3: "conflict", 4: "missing_published", 9: "missing_recomputed"}
    none = reconcile(rec, None, "yr")
    assert none.schema.simpleString() == reconcile(rec, pub, "yr").schema.simpleString()
    assert {r.status for r in none.collect()} == {"missing_published"}


def test_fuzzy_work_does_not_grow_with_the_square(spark):
    """Names of one block that share a prefix, at sizes over six decades: few candidates."""
    import random
    rnd = random.Random(5)
    rows = [("PARNA", "SERRA DO MAR LONGA " + "".join(rnd.choice("ABCDEFGH") for _ in range(8)),
             10 ** rnd.uniform(0, 6)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "cat string, name string, size double")
    from ashgrid.operators import fuzzy
    import math
    ent = df.select("cat", F.col("name").alias("__name"),
                    F.floor(F.log("size") / F.lit(2.0 * -math.log1p(-0.01))).alias("__bucket")).distinct()
    plan_rows = fuzzy._name_pairs(ent, ["cat"], 2)
    assert plan_rows.count() < 100
    assert {tuple(r) for r in fuzzy_pairs(df, "name", "size", ["cat"]).collect()} == brute_pairs(rows, 2, 0.01)
