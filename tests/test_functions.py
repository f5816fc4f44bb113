"""Column functions, one behaviour per test."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ashgrid.functions import (category, clean_text, component_sum, null_if,
                               parse_date, percent_of, round_half_up, split_known,
                               split_values, unit_key)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,clean", [
    ("PARNA DA SERRA ", "PARNA DA SERRA"),
    ("PARNA DA PEDRA NOVA*", "PARNA DA PEDRA NOVA"),
    ("  X ** ", "X"),
    ("MATA ATLANTICA  E   CERRADO", "MATA ATLANTICA E CERRADO"),
    ("Landsat ", "Landsat"),
    ("   ", None),
    (None, None),
])
def test_clean_text(spark, raw, clean):
    assert one(spark, clean_text("v"), raw) == clean


@pytest.mark.parametrize("raw,key", [
    ("PARNA DAS FLORES-AZUIS", "PARNA FLORES AZUIS"),
    ("PARNA DAS FLORES AZUIS", "PARNA FLORES AZUIS"),
    ("REBIO DAS LAGOAS", "REBIO LAGOAS"),
    ("REBIO LAGOAS", "REBIO LAGOAS"),
    ("apa da bacia do rio x", "APA BACIA X"),
    ("DE DA DO", None),
    ("PARNA DA SERRA DOS ÓRGÃOS", "PARNA SERRA ORGAOS"),
])
def test_unit_key(spark, raw, key):
    assert one(spark, unit_key("v"), raw) == key


def test_category(spark):
    assert one(spark, category("v"), "  RESEX DO MAR") == "RESEX"
    assert one(spark, category("v"), "") is None


def test_split_values(spark):
    assert one(spark, split_values("v"), "Landsat / Sentinel") == ["Landsat", "Sentinel"]
    assert one(spark, split_values("v"), "Modis") == ["Modis"]
    assert one(spark, split_values("v"), None) is None


def test_split_known_keeps_unknown_whole(spark):
    known = ["MATA ATLANTICA", "CERRADO"]
    assert one(spark, split_known("v", known), "MATA ATLANTICA E CERRADO") == ["MATA ATLANTICA", "CERRADO"]
    assert one(spark, split_known("v", known), "PARNA E HISTORICO") == ["PARNA E HISTORICO"]
    assert one(spark, split_known("v", known), "CERRADO") == ["CERRADO"]


def test_null_if(spark):
    assert one(spark, null_if("v"), "-") is None
    assert one(spark, null_if("v"), " - ") is None
    assert one(spark, null_if("v"), "Grupo") == "Grupo"


@pytest.mark.parametrize("raw,d", [
    ("07/03/2014", dt.date(2014, 3, 7)),
    ("2014-03-07", dt.date(2014, 3, 7)),
    ("", None),
    ("31/02/2020", None),
    ("garbage", None),
])
def test_parse_date(spark, raw, d):
    assert one(spark, parse_date("v"), raw) == d


def test_percent_of(spark):
    df = spark.createDataFrame([(1234.5, 50000.0), (1.0, 0.0), (1.0, -5.0), (None, 1.0)],
                               "a double, w double")
    got = [r[0] for r in df.select(percent_of("a", "w")).collect()]
    assert got[0] == pytest.approx(2.469, rel=1e-9)
    assert got[1:] == [None, None, None]


def test_round_half_up_beyond_decimal_range(spark):
    df = spark.createDataFrame([(1e30,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [1e30, None]


def test_round_half_up_uses_printed_digits(spark):
    df = spark.createDataFrame([(1.005,), (0.435,), (2.675,), (0.0001,), (-1.005,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [1.01, 0.44, 2.68, 0.0, -1.01]


def test_component_sum_null_is_not_zero(spark):
    df = spark.createDataFrame([(None, None), (6.0, None), (0.0, 0.0), (1.25, 2.5)], "a double, b double")
    got = [r[0] for r in df.select(component_sum(["a", "b"])).collect()]
    assert got == [None, 6.0, 0.0, 3.75]
    got = [r[0] for r in df.select(component_sum(["a", "b"], "decimal(18,2)")).collect()]
    assert got == [None, 6.0, 0.0, 3.75]


def test_exact_sum_is_order_free_and_matches_decimal(spark):
    from ashgrid.functions.numeric import exact_sum
    vals = [0.1, 0.2, 12345.67, 1e6 + 0.01, -3.35, None] * 50
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, v double")
    a = {r.g: r.s for r in df.groupBy("g").agg(exact_sum("v", "decimal(18,2)").alias("s")).collect()}
    b = {r.g: r.s for r in df.groupBy("g").agg(
        F.sum(F.col("v").cast("decimal(18,2)")).cast("double").alias("s")).collect()}
    c = {r.g: r.s for r in df.repartition(7).groupBy("g").agg(exact_sum("v", "decimal(18,2)").alias("s")).collect()}
    assert a == b == c
    wide = {r.g: r.s for r in df.groupBy("g").agg(exact_sum("v", "decimal(38,12)").alias("s")).collect()}
    assert wide == a
