import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashgrid.llm import sharding as S
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ROWS, no_docs, odd_docs, read


def check(rows, shards):
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def test_query_equals_brute_force(spark):
    ids, texts = read(SF_ORACLE, "documents", "doc_id", "text")
    rows = S.op5_sharding(spark, SF_ORACLE).collect()
    size = {i: len(t.encode()) + 1 for i, t in zip(ids, texts, strict=True)}
    assert {r.doc_id: r.size for r in rows} == size
    assert {r.doc_id: r.text_crc32 for r in rows} == \
        {i: zlib.crc32(t.encode()) for i, t in zip(ids, texts, strict=True)}
    sums = check(rows, 16)
    # a cut misses its place by half of the row there, and a shard has two cuts
    assert max(abs(s - sum(sums) / 16) for s in sums) <= max(size.values()) + 0.002 * sum(sums) / 16
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_splitters_equal_sorting(spark):
    rng = np.random.default_rng(3)
    keys, sizes = rng.integers(-2**62, 2**62, 4000), rng.integers(1, 50, 4000)
    df = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes, strict=True)],
                               "__key long, __size long").repartition(4)
    total = int(sizes.sum())
    cuts = S.splitters(df, total, 8, 0)
    for i, cut in enumerate(np.sort(cuts), 1):
        below = int(sizes[keys < cut].sum())
        nearest = min(abs(int(sizes[keys < k].sum()) - total * i // 8) for k in keys)
        assert abs(below - total * i // 8) <= nearest


def test_hot_text_is_cut_and_equal_texts_are_neighbours(spark):
    rows = [(i, "the same text of many rows") for i in range(3000)]
    rows += [(3000 + i, f"text number {i % 1500}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = S.shard(docs, 8, range_rows=300).collect()
    sums = check(got, 8)
    assert max(sums) - min(sums) <= 60
    text = dict(rows)
    homes = {}
    for r in got:
        if r.doc_id >= 3000:
            homes.setdefault(text[r.doc_id], set()).add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 8


def test_ranges_do_not_change_the_result(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("x"), F.col("id").cast("string")).alias("text"))
    one = S.shard(docs, 4).collect()
    many = S.shard(docs, 4, range_rows=100).collect()
    check(many, 4)
    assert {r.doc_id: r.shard for r in one}.items() ^ {r.doc_id: r.shard for r in many}.items() == set()


@pytest.mark.parametrize("shards", [1, 3])
def test_rows(spark, shards):
    got = S.shard(odd_docs(spark), shards, keep=("label",)).collect()
    assert sorted((r.doc_id or 0, r.size, r.label) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 1, "extra label") for i, t in ROWS)
    check(got, shards)
    assert S.shard(no_docs(spark), shards).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", i % 3) for i in range(60)],
                                 "doc_id long, text string, size int")
    S.write_shards(docs, 4, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(i, f"text {i}") for i in range(60)]
    assert back.select("shard").distinct().count() == 4


@pytest.mark.parametrize("rows", [
    [(1, "one repeated row")] * 320, [(None, "one of two texts"), (None, "another text here")] * 160,
    [(1, "one repeated row")] * 160 + [(i, f"text {i} of its own") for i in range(160)]])
def test_repeated_rows_are_cut(spark, rows):
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)],
                                 "doc_id long, text string, label int").repartition(4)
    for keep in ((), ("label",)):
        got = S.shard(docs, 16, keep=keep).collect()
        sums = check(got, 16)
        assert max(sums) - min(sums) <= 2 * max(len(t) + 1 for _, t in rows)
        assert len(got) == 320
        if keep:
            assert sorted(r.label for r in got) == list(range(320))


def test_a_hot_repeated_row_is_cut_into_ranges(spark):
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("no id")).otherwise(
            F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text")).repartition(5)
    got = S.shard(docs, 8, range_rows=200).collect()
    sums = check(got, 8)
    assert max(sums) - min(sums) <= 60 and len(got) == 6000
