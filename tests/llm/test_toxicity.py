import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ashgrid.llm import toxicity as T
from ashgrid.llm import words as W
from tests.conftest import SF_SMALL
from tests.llm.helpers import ROWS, no_docs, odd_docs, read

SF = "/root/testdata/sf0.1"


def tokens(text):
    """The words of a text, cut by the byte positions of its chunk."""
    out = []
    for w in W.chunks(pa.array([text])):
        out += [w.data[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)]
    return out


def random_index(seed, examples=700, terms=60, k=10):
    rng = np.random.default_rng(seed)
    names = np.sort(rng.choice(2**62, terms, replace=False).astype(np.uint64))
    rows = []
    for i in range(examples):
        h = np.sort(rng.choice(names, rng.integers(0, 9), replace=False))
        rows.append((f"e{i}", int(rng.random() < 0.3), h, rng.integers(1, 5, len(h))))
    first = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows])))
    term = np.searchsorted(names, np.concatenate([r[2] for r in rows]))
    index = T.build(np.array([r[0] for r in rows], object), np.array([r[1] for r in rows]), first, term,
                    np.concatenate([r[3] for r in rows]), names, rng.uniform(0.5, 3, terms), k)
    return index, rows, rng


def dense(index):
    """Every example's vector, from the postings."""
    vectors = np.zeros((len(index.labels), len(index.terms)))
    for t in range(len(index.terms)):
        at = slice(index.first[index.entry[t]], index.first[index.entry[t + 1]])
        vectors[index.example[at], t] = index.weight[at]
    return vectors


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("long", [0, 55, 128])
def test_neighbours_equal_brute_force(monkeypatch, seed, long):
    monkeypatch.setattr(T, "LONG", long)
    index, _, rng = random_index(seed)
    vectors = dense(index)
    assert np.allclose(np.linalg.norm(vectors, axis=1), 1, atol=1e-6)
    for _ in range(40):
        term = np.sort(rng.choice(len(index.terms), rng.integers(1, 6), replace=False))
        weight = rng.uniform(0.1, 1, len(term))
        weight /= np.linalg.norm(weight)
        cosine = vectors[:, term] @ weight
        order = np.lexsort((np.arange(len(cosine)), -cosine.round(9)))
        want = [i for i in order[:index.k] if cosine[i] > 0]
        (found, near), = index.nearest(np.array([0, len(term)]), term, weight)
        assert np.allclose(near, cosine[want], atol=1e-6)
        assert np.allclose(np.sort(cosine[found]), np.sort(cosine[want]), atol=1e-6)


def test_block_bounds_are_the_largest_weights():
    index, _, _ = random_index(9, examples=3000, k=3)
    vectors = dense(index)
    for t in range(len(index.terms)):
        for e in range(index.entry[t], index.entry[t + 1]):
            lo = index.block[e] * T.BLOCK
            assert index.most[e] == vectors[lo:lo + T.BLOCK, t].max().astype(np.float32)
    (found, near), = index.nearest(np.array([0, 1]), np.array([5]), np.array([1.0]))
    at = slice(index.entry[5], index.entry[6])
    assert len(found) == 3 and near[0] == pytest.approx(index.most[at].max())


def test_every_example_with_a_word_is_in_the_index():
    index, rows, _ = random_index(2)
    assert set(index.ids) == {r[0] for r in rows if len(r[2])}


def test_the_query_equals_brute_force_cosine(spark):
    """Frequencies, weights, neighbours and votes of whole texts by plain dictionaries."""
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    sample = T.labelled_sample(spark.read.parquet(f"{SF_SMALL}/documents.parquet"),
                               spark.read.parquet(f"{SF_SMALL}/labels.parquet"), T.MAX_EXAMPLES).collect()
    index = T.fit(spark.createDataFrame(sample), spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    share = sum(r.label for r in sample) / len(sample)
    held, often, n, k = {}, {}, {}, {}
    for t in texts:
        for x in set(tokens(t)):
            often[x] = often.get(x, 0) + 1
    for r in sample:
        for x in set(tokens(r.text)):
            n[x], k[x] = n.get(x, 0) + 1, k.get(x, 0) + r.label

    def rate(x):
        p = k[x] / n[x]
        gain = n[x] * sum(q * math.log(q / s) for q, s in ((p, share), (1 - p, 1 - share)) if q)
        return math.log(1 + len(texts) / often[x]) * (T.FLOOR + (1 - T.FLOOR) * gain / (gain + T.HALF))

    def vector(text):
        v = {x: (1 + math.log(c)) * rate(x) for x, c in Counter(tokens(text)).items() if x in n}
        norm = math.sqrt(sum(a * a for a in v.values()))
        return {x: a / norm for x, a in v.items()}

    held = {str(r.doc_id): (r.label, vector(r.text)) for r in sample if tokens(r.text)}
    assert set(index.ids) == set(held)
    got = {r.doc_id: r for r in T.op7_toxicity(spark, SF_SMALL).collect()}
    with_neighbours = 0
    for i, t in zip(ids, texts, strict=True):
        v = vector(t)
        cosine = sorted(((sum(a * u.get(x, 0) for x, a in v.items()), y) for y, u in held.values()),
                        reverse=True)[:index.k]
        near = [(c, y) for c, y in cosine if c > 1e-9]
        with_neighbours += bool(near)
        vote = ((sum(c * c * y for c, y in near) + index.pull * index.prior)
                / (sum(c * c for c, _ in near) + index.pull))
        assert got[i].score == pytest.approx(index.calibrated(np.array([vote]))[0], abs=1e-4)
        assert bool(got[i].evidence) == bool(near)
    assert with_neighbours > 0.97 * len(ids)


def test_votes_are_calibrated_upwards():
    index, _, _ = random_index(1)
    assert index.slope > 0
    assert (np.diff(index.calibrated(np.linspace(0, 1, 9))) > 0).all()


def test_rows(spark):
    labelled = spark.createDataFrame(
        [(i, "you idiot fool" if i % 3 == 0 else f"kind words number {i}", int(i % 3 == 0))
         for i in range(60)] + [(99, "idiot", None), (100, None, 0)], "doc_id long, text string, label int")
    index = T.fit(labelled)
    got = T.score(odd_docs(spark), index, keep=("label",)).collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i, _ in ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert T.score(no_docs(spark), index).count() == 0
    toxic = spark.createDataFrame([(1, "what an IDIOT"), (2, "kind words"), (3, None)],
                                  "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in T.score(toxic, index).collect()} == {1: 1, 2: 0, 3: 0}
    assert sorted(r.doc_id for r in T.drop_toxic(toxic, index).collect()) == [2, 3]
    nothing = T.fit(labelled.limit(0))
    assert {r.predicted for r in T.score(toxic, nothing).collect()} <= {0, 1}


def test_held_out_accuracy(spark):
    ids, labels = read(SF, "labels", "doc_id", "toxic")
    known = dict(zip(ids, labels, strict=True))
    rows = T.op7_toxicity(spark, SF).collect()
    assert len(rows) == 10_000
    held = [r for r in rows if r.held_out and r.doc_id in known]
    caught = [r.predicted for r in held if known[r.doc_id] == 1]
    spared = [r.predicted for r in held if known[r.doc_id] == 0]
    assert np.mean(caught) > 0.8 and np.mean(spared) < 0.01
    assert any(r.evidence for r in rows if r.predicted)
    assert np.mean([bool(r.evidence) for r in rows]) > 0.97
