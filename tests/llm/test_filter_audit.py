import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from ashgrid.llm import filter_audit as A
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ROWS, no_docs, odd_docs, read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """The letters each (id, text) fails, by the definition."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        out.append("".join(k for k, v in f.items() if v))
    return out


def simulate(rows, parts, good, toxic):
    """Every order by removing row after row."""
    failed = failures(rows)
    out, by_order = {}, {}
    for part in set(parts):
        mine = [k for k, p in enumerate(parts) if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [k for k in left if x in failed[k]]
                left = [k for k in left if x not in failed[k]]
                by_order[part, x] = by_order.get((part, x), 0) + len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(x in failed[k] for k in mine) - len(gone),
                    sum(failed[k] == x for k in mine), sum(rows[k][0] in good for k in gone),
                    sum(rows[k][0] in toxic for k in gone))
    return {k: (*v, by_order[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def table(df):
    return {(r.part, r.filter_order, r.step):
            (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_query_equals_a_simulation(spark):
    ids, texts, parts = read(SF_ORACLE, "documents", "doc_id", "text", "source")
    lid, quality, toxic = read(SF_ORACLE, "labels", "doc_id", "quality", "toxic")
    got = table(A.op13_filter_audit(spark, SF_ORACLE))
    want = simulate(list(zip(ids, texts, strict=True)), [p or "" for p in parts],
                    {i for i, q in zip(lid, quality, strict=True) if q == 1},
                    {i for i, q in zip(lid, toxic, strict=True) if q == 1})
    assert got == want


def audit(docs, labels):
    counts = A.combinations(docs, A.text_filters(), "E", labels=labels, marks={
        "good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    return A.orders(counts, "ABCDE", {"good": "good_lost", "toxic": "toxic_lost"})


def test_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (10, 0, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = odd_docs(spark).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "even")
                                      .when(F.col("doc_id") == 3, ""))
    got = table(audit(docs, labels))
    parts = ["even" if i is not None and i % 2 == 0 else "" for i, _ in ROWS]
    assert got == simulate(ROWS, parts, {1}, {10})
    assert audit(no_docs(spark).withColumn("source", F.lit("x")), labels).count() == 0


def test_hot_copies_are_counted_without_pairs(spark):
    copies = 4000
    docs = spark.range(3 * copies).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the one text")).otherwise(
            F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
        F.lit("s").alias("source")).repartition(6)
    counts = A.combinations(docs, A.text_filters(), "E")
    by = Counter({r.failed: r.n for r in counts.collect()})
    assert by == {0b00001: 2 * copies + 1, 0b10001: copies - 1}


def test_marks_and_filters_of_ones_own(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a"), (4, "ccc")], "k long, body string")
    docs = docs.withColumn("shop", F.lit("s"))
    filters = {"S": F.length("body") < 2, "L": F.length("body") > 2}
    counts = A.combinations(docs, filters, "R", id_col="k", text_col="body", part_col="shop")
    assert {r.failed: r.n for r in counts.collect()} == {0b001: 1, 0b000: 1, 0b101: 1, 0b010: 1}
    rows = {(r.filter_order, r.step): (r.removed, r.redundant, r.shapley)
            for r in A.orders(counts, "SLR", {}).collect()}
    assert len(rows) == 18
    assert rows["RSL", 1] == (1, 0, 3) and rows["RSL", 2] == (1, 1, 9)
