import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ashgrid.llm import substrings as S
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ROWS, no_docs, odd_docs, read


def split(text):
    return (text or "").encode().split()


def brute(rows, least):
    """Row by row: (number of words, kept words); rows without an id are kept whole."""
    first = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - least + 1):
            v = tuple(w[k:k + least])
            if i is not None:
                first[v] = min(first.get(v, i), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for k in range(len(w) - least + 1):
            if i is not None and first[tuple(w[k:k + least])] < i:
                gone.update(range(k, k + least))
        out.append((i, len(w), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def run(spark, rows, least, seed, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = S.remove(docs, least=least, seed=seed).collect()
    for r in got:
        assert sum(s["end"] - s["start"] for s in r.repeats) == r.n_words - len(split(r.text))
        assert all(a["end"] < b["start"] for a, b in zip(r.repeats, r.repeats[1:]))
        assert all(s["end"] - s["start"] >= least for s in r.repeats)
    return sorted(((r.doc_id, r.n_words, r.text) for r in got), key=repr)


def same(spark, rows, least, seed):
    assert run(spark, rows, least, seed) == sorted(brute(rows, least), key=repr)


def test_query_equals_brute_force(spark):
    ids, texts = read(SF_ORACLE, "documents", "doc_id", "text")
    want = {i: (n, n - len(split(t)), hashlib.sha256(t.encode()).hexdigest())
            for i, n, t in brute(list(zip(ids, texts, strict=True)), 50)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in S.op12_substring_dedup(spark, SF_ORACLE).collect()}
    assert got == want
    assert sum(n > 0 for _, n, _ in got.values()) > 50


def planted(rng, docs, alphabet, least):
    """Texts over few words that share, cut, shift and repeat passages of each other."""
    words = [f"w{k}" for k in range(alphabet)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(least // 2, 3 * least))] for _ in range(6)]
    rows = []
    for i in range(docs):
        text = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            lo = rng.randrange(len(p) // 2)
            text += p[lo:rng.randrange(lo, len(p) + 1)]
            text += [rng.choice(words) for _ in range(rng.randrange(6))]
        rows.append((rng.randrange(10 * docs), " ".join(text)))
    return rows


def test_shared_passages_equal_brute_force(spark):
    rng = random.Random(8)
    for alphabet, least, seed in ((3, 8, 3), (40, 12, 4), (2000, 20, 5), (1, 6, 2), (40, 9, 9)):
        same(spark, planted(rng, 60, alphabet, least), least, seed)


def test_rows_of_one_id_and_repeated_rows(spark):
    rng = random.Random(9)
    rows = planted(rng, 40, 60, 10)
    rows = [(i % 7, t) for i, t in rows] + rows[:5] + rows[:5] + [(None, t) for _, t in rows[:8]]
    same(spark, rows, 10, 4)


def test_a_passage_in_a_third_of_the_documents(spark):
    rng = random.Random(10)
    hot = " ".join(f"h{k}" for k in range(60))
    rows = [(i, f"own{i} own{i + 1} " * 3 + (hot if i % 3 == 0 else "") + f" end{i} " * rng.randrange(5))
            for i in range(900)]
    rows += [(1000 + i, "a copy of the one text " * 12) for i in range(300)]
    got = run(spark, rows, 50, 10, parts=6)
    assert got == sorted(brute(rows, 50), key=repr)


def test_rows(spark):
    got = S.remove(odd_docs(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got) == sorted((i or 0, len(split(t))) for i, t in ROWS)
    assert S.remove(no_docs(spark)).count() == 0


def test_unspaced_and_long_words(spark):
    long = "z" * 300_000
    rows = [(1, " ".join([long] * 3 + ["a", "b", "c", "d"])), (2, " ".join(["q", long, long, "a", "b", "c"])),
            (3, "漢字 " * 40), (4, "漢字　漢字 " * 40), (5, "漢字\t" * 20)]
    same(spark, rows, 4, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4))
def test_every_passage_has_one_anchor_set_by_its_words(texts):
    least, seed = 6, 2
    hashes = S.Hashes([" ".join(t) for t in texts])
    text, start, number, anchor = S.stretches(hashes, least, seed)
    place = {}
    for t, s, n, a in zip(text, start, number, anchor, strict=True):
        for k in range(s, s + n):
            v = tuple(texts[t][k:k + least])
            within = a - hashes.first[t] - k
            assert 0 <= within <= least - seed
            assert place.setdefault(v, within) == within
    assert int(np.sum(number)) == sum(max(0, len(t) - least + 1) for t in texts)
