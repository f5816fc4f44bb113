import random
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ashgrid.llm import jaccard as J
from ashgrid.llm.catalog import SQL
from ashgrid.llm.components import components
from tests.conftest import SF_SMALL
from tests.llm.helpers import grams, no_docs, odd_docs, words


def brute_force(rows, threshold=0.8):
    """(class, links) of every row by comparing all pairs of sets."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        least[find(i)].append(name)
    named = {k: min((n for n in v if n is not None), default=None) for k, v in least.items()}
    return sorted(((n or 0), (named[find(i)] or 0), links[i]) for i, (n, _) in enumerate(rows))


def found(df):
    return sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in df.collect())


def near_rows(n, length, edits, seed, first=0):
    """A graded group: every text is an earlier one with a few words changed."""
    rng = random.Random(seed)
    texts = [[f"w{rng.randrange(500)}" for _ in range(length)]]
    while len(texts) < n:
        t = list(rng.choice(texts))
        for _ in range(edits):
            t[rng.randrange(length)] = f"w{rng.randrange(500)}"
        texts.append(t)
    return [(first + i, " ".join(t)) for i, t in enumerate(texts)]


def test_bands_reach_the_recall():
    bands, rows = J.choose_bands(0.8)
    assert (bands, rows) == (31, 6)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999
    assert J.choose_bands(1.0)[0] == 1
    with pytest.raises(ValueError):
        J.choose_bands(0.01, 0.9999, 8)


@pytest.mark.parametrize("block, many", [(512, 64), (16, 64), (16, 1)])
def test_equals_brute_force(spark, monkeypatch, block, many):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "MANY", many)
    rows = near_rows(90, 120, 1, 1) + near_rows(30, 40, 1, 2, 1000) + near_rows(40, 200, 60, 3, 2000)
    rows += [(3000 + i, rows[i % 5][1]) for i in range(60)]                # copies
    rows += [(4000, "few words"), (4001, "Few, words!"), (4002, "other few words")]
    random.Random(4).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(J.join(docs)) == brute_force(rows)


def test_rows(spark):
    docs = odd_docs(spark)
    assert found(J.join(docs)) == brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert J.join(no_docs(spark)).count() == 0
    kept = J.one_of_each(docs).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 6, 7, 8, 10]
    assert kept[0].asDict().keys() == set(docs.columns)


def test_one_of_each_decides_rows_by_id_and_text(spark):
    def text(k, *more):
        return " ".join([f"t{k}w{i}" for i in range(40)] + list(more))

    rows = [(1, text(1)), (2, text(1, "more")), (None, text(1)),        # null id beside ids
            (None, text(2)), (None, text(2, "more")), (None, text(2)),  # null ids only
            (None, text(3)),
            (4, text(4)), (5, text(5)), (5, text(4)), (5, text(5))]     # an id with two texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id or 0, words(r.text)[0]) for r in J.one_of_each(docs).collect()))
    assert kept == [(0, "t2w0"), (0, "t3w0"), (1, "t1w0"), (4, "t4w0"), (5, "t5w0")]


def test_query_equals_sql(spark):
    got = found(J.op3_jaccard_join(spark, SF_SMALL))
    with duckdb.connect() as con:
        con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
        assert got == sorted(con.execute(
            f"select doc_id, class_id, n_links from ({SQL['op3_jaccard_join']})").fetchall())


def test_common_counts_equal_sets():
    rng = np.random.default_rng(0)
    left, right = ([np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in sizes]
                   for sizes in ((5, 90, 1, 40), (200, 3, 60)))
    got = J.common_counts(left, right)
    assert got.tolist() == [[len(set(a) & set(b)) for b in right] for a in left]


def test_digest_is_of_the_set():
    texts = pa.array(["a b c d e a b c d e a b c d e", "a b c d e a b c d e", "x", None])
    keys = [k for _, _, k in J.gram_sets(texts, 5)]
    assert keys[0] == keys[1] != keys[2] != keys[3]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 0 for i in range(50)} | {200: 200, 300: 200}
    assert got == want
    assert components(df.limit(0)).count() == 0


def test_a_chain_travels_in_proportion(spark, monkeypatch):
    """Texts that are like their neighbours only: no set meets a whole group, no link is missed."""
    monkeypatch.setattr(J, "BLOCK", 16)
    share = []
    for n in (100, 800):
        texts = [" ".join(f"w{8 * i + j}" for j in range(200)) for i in range(n)]
        sets = [(key, g.tobytes()) for _, g, key in J.gram_sets(pa.array(texts), 5)]
        place = {key: i for i, (key, _) in enumerate(sets)}
        grams_ = spark.createDataFrame(sets, "key binary, grams binary").repartition(4)
        parts = grams_.select("key", F.lit(b"one").alias("part"))
        sent = J._by_prefix(parts, grams_, 0.8).collect()
        met = defaultdict(lambda: (set(), set()))
        for r in sent:
            met[r.left, r.right][r.own].add(place[bytes(r.key)])
        for i in range(n):
            for j in (i + 1, i + 2):                     # what reaches 0.8 in this chain
                if j < n:
                    assert any({i, j} <= a | b and (i in a) != (j in a) or {i, j} <= a and not b
                               for a, b in met.values())
        share.append(len(sent) / n)
    assert share[1] < 2 * share[0] < 16


def test_a_dense_group_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 16)
    monkeypatch.setattr(J, "MANY", 1)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(150):
        t = list(base)
        t[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(J.join(docs)) == brute_force(rows)


def test_clashing_names_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "kept")], "doc_id long, text string, first_id string")
    assert [r.asDict() for r in J.one_of_each(docs.withColumn("text_hash", docs["first_id"])).collect()] == \
        [{"doc_id": 1, "text": "a b c d e f", "first_id": "kept", "text_hash": "kept"}]
