import hashlib

import numpy as np
from pyspark.sql import functions as F

from ashgrid.llm import fingerprints as FP
from tests.conftest import SF_SMALL
from tests.llm.helpers import ROWS, grams, no_docs, odd_docs, read


def edit(text, following):
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def jaccard(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def test_query_equals_brute_force(spark):
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    got = {r.doc_id: r for r in FP.op4_fingerprints(spark, SF_SMALL).collect()}
    assert sorted(got) == ids
    off, off_next = [], []
    for i, t, n in zip(ids, texts, texts[1:] + texts[:1], strict=True):
        changed = edit(t, n)
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        off.append(got[i].near_edited - jaccard(t, changed))
        off_next.append(got[i].near_next - jaccard(t, n))
    # 256 bins of 4 bits: a standard error of at most 0.034
    assert np.sqrt(np.mean(np.square(off))) < 0.04 and np.abs(off).max() < 0.17
    assert np.sqrt(np.mean(np.square(off_next))) < 0.03
    marks = {}
    for i, t in zip(ids, texts, strict=True):
        marks.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(m) == 1 for m in marks.values())


def test_plan_has_no_python_and_no_single_task_order(spark):
    plan = FP.op4_fingerprints(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def test_bins_keep_least_hashes_and_sentinels(spark):
    hashes = [5, (3 << FP._SHIFT) + 9, (3 << FP._SHIFT) + 2]
    row = spark.createDataFrame([(hashes,)], "h array<long>").select(
        FP.bin_minima(F.col("h")).alias("m")).first()
    assert len(row.m) == FP.BINS
    assert row.m[0] == 5 and row.m[3] == (3 << FP._SHIFT) + 2
    assert all(x == (b << FP._SHIFT) | FP._LOW for b, x in enumerate(row.m) if b not in (0, 3))


def test_few_shingles_fill_all_bins_and_stay_apart(spark):
    texts = ["one two three", "one two four", "a b c d e f g", "", "!!"]
    got = [r.f for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
           .orderBy("i").select(FP.fingerprint(F.col("t")).alias("f")).collect()]
    assert all(len(f) == FP.BINS for f in got)
    assert got[3] == got[4]
    same = sum(a == b for a, b in zip(got[0], got[1], strict=True)) / FP.BINS
    assert same < 0.15                       # chance is a sixteenth


def test_order_over_ranges(spark):
    rows = [(k, f"t{k}") for k in range(0, 500, 7)] + [(None, "null a"), (None, "null b"), (70, "a70")]
    df = spark.createDataFrame(rows, "k long, v string").repartition(5)
    got = FP.with_next(df, "k", "v", {"v": "n"}, parts=9).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = {(*a, b[1]) for a, b in zip(want, want[1:] + want[:1], strict=True)}
    assert {tuple(r) for r in got} == expected and len(got) == len(rows)


def test_rows(spark):
    got = FP.fingerprints(odd_docs(spark)).collect()
    order = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted(((i or 0, len(t), hashlib.sha256(edit(t, n[1]).encode()).hexdigest())
                   for (i, t), n in zip(order, order[1:] + order[:1], strict=True)))
    assert sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == want
    assert FP.fingerprints(no_docs(spark)).count() == 0
    one = FP.fingerprints(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string"))
    assert one.first().near_next == 1.0
