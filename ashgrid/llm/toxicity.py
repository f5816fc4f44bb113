"""Toxicity by nearest labelled examples: exact TF-IDF cosine, block-max index.

Texts are vectors of all their words that occur among the labelled examples,
of unit length.  A word weighs its inverse document frequency, counted over
all documents, times how much it tells about the label: the evidence (n times
the Kullback-Leibler divergence of the label's share among its n examples from
the share among all) over itself plus a constant.  Common words and words of
few examples thus count little, but every example is in the index and
every text that shares a word with one has neighbours.

The inverted index cuts the postings of every word into blocks of examples
and stores each block's largest weight.  A query scores the short postings,
those of all but the commonest words, in full: that is a lower bound of every
cosine.  The block maxima of its common words bound what these can add, and
only blocks with an example whose bound reaches the k-th best are completed: the
neighbours are exact.  Bounds and completions of some texts at once are small
matrix products over the common words.  The neighbours vote with squared
similarities against the labels' prior share, and the votes are calibrated
(Platt) on leave-one-out votes of the examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .frames import fresh, id_hash_mod, kind, map_batches, ship, table

BLOCK = 64
#: Words of more postings than LONG, the COMMON most frequent of them at most, are
#: common ones: their blocks give bounds.
LONG, COMMON = 128, 512
#: Texts that are scored together.
TOGETHER = 64
#: Least weight of a word that tells nothing, and the evidence that counts half.
FLOOR, HALF = 0.02, 10.0
#: Labelled rows that the registered query's index holds at most.
MAX_EXAMPLES = 8000


def term_counts(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, word hash, count) of a chunk, ordered by text and word."""
    owner = np.repeat(np.arange(w.hi - w.lo), np.diff(w.first))
    order = np.lexsort((w.hash, owner))
    h, o = w.hash[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return o[at], h[at], np.diff(np.append(at, len(h)))


def _ranges(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of ``lo[i] .. lo[i] + size[i] - 1``, one run after the other."""
    return np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)


@dataclass
class Index:
    """Labelled examples as a block-max inverted index over all their words."""

    terms: np.ndarray        # sorted word hashes
    rate: np.ndarray         # weight of each word
    ids: np.ndarray          # id of each example, as text
    labels: np.ndarray
    entry: np.ndarray        # of each term: its first entry, and one more
    block: np.ndarray        # entries, by term: block, and its largest weight
    most: np.ndarray
    first: np.ndarray        # of each entry: its first posting, and one more
    example: np.ndarray      # postings: example
    weight: np.ndarray       # postings: weight in the example's unit vector
    long: np.ndarray         # of each term: its place among the common ones, else -1
    ceiling: np.ndarray      # [common word, block] -> largest weight
    shared: np.ndarray       # [common word, example] -> weight
    prior: float             # label share among all sampled rows
    k: int
    pull: float              # weight of the prior in a vote
    slope: float = 1.0       # calibration: logistic(slope * vote + shift)
    shift: float = 0.0

    def vectors(self, owner: np.ndarray, h: np.ndarray, count: np.ndarray, texts: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit TF-IDF vectors: (first entry of each text, term, weight)."""
        if not len(self.terms):
            return np.zeros(texts + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        known = self.terms[at] == h
        owner, term = owner[known], at[known]
        value = (1.0 + np.log(count[known])) * self.rate[term]
        norm = np.sqrt(np.bincount(owner, value * value, texts))
        return (np.searchsorted(owner, np.arange(texts + 1)), term, value / norm[owner])

    def nearest(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray,
                skip: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each vector the ``k`` examples of highest positive cosine, ties by lower index.

        Vector i has the entries ``first[i]`` to ``first[i + 1]``; example ``skip[i]`` is left out.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for lo in range(0, len(first) - 1, TOGETHER):
            cut = first[lo:lo + TOGETHER + 1]
            at = slice(cut[0], cut[-1])
            out += self._together(cut - cut[0], term[at], weight[at],
                                  None if skip is None else skip[lo:lo + TOGETHER])
        return out

    def _together(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray,
                  skip: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
        n, texts = len(self.labels), len(first) - 1
        blocks = self.ceiling.shape[1]
        place = self.long[term]
        common = place >= 0
        query = np.zeros((texts, len(self.shared)), np.float32)
        query[np.repeat(np.arange(texts), np.diff(first))[common], place[common]] = weight[common]
        begin = self.first[self.entry[term]]
        size = np.where(common, 0, self.first[self.entry[term + 1]] - begin)
        scores = np.zeros((texts, blocks * BLOCK), np.float32)
        for i in range(texts):
            own = slice(first[i], first[i + 1])
            at = _ranges(begin[own], size[own])
            if len(at):
                scores[i, :n] = np.bincount(self.example[at], np.repeat(weight[own], size[own])
                                            * self.weight[at], n)
        if skip is not None:
            scores[np.arange(texts), skip] = -1.0
        if len(self.shared):
            kth = (np.partition(scores[:, :n], n - self.k, axis=1)[:, n - self.k] if n > self.k
                   else np.zeros(texts, np.float32))
            best = scores.reshape(texts, blocks, BLOCK).max(axis=2) + query @ self.ceiling
            reach = (best > 0) & (best >= np.maximum(kth, 0)[:, None] - 1e-5)
            for block in np.flatnonzero(reach.any(axis=0)).tolist():
                rows, at = np.flatnonzero(reach[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                scores[rows, at] += query[rows] @ self.shared[:, at]
            if skip is not None:
                scores[np.arange(texts), skip] = -1.0
        out = []
        for row in scores[:, :n]:
            kth = max(np.partition(row, n - self.k)[n - self.k], 0.0) if n > self.k else 0.0
            found = np.flatnonzero((row >= kth) & (row > 0))
            found = found[np.lexsort((found, -row[found]))[:self.k]]
            out.append((found, row[found].astype(float)))
        return out

    def vote(self, found: np.ndarray, similarity: np.ndarray) -> float:
        s = similarity * similarity
        return float((s @ self.labels[found] + self.pull * self.prior) / (s.sum() + self.pull))

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * votes + self.shift, -35, 35)))


def build(names: np.ndarray, labels: np.ndarray, first: np.ndarray, term: np.ndarray,
          count: np.ndarray, terms: np.ndarray, rate: np.ndarray, k: int = 16,
          pull: float = 0.5) -> Index:
    """Index of examples, calibrated; example i has the (term, count) entries from ``first[i]``.

    Examples without a word are similar to nothing; they count in the prior only.
    """
    size = np.diff(first)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    owner = np.repeat(np.arange(len(names), dtype=np.int32), size)
    weight = ((1.0 + np.log(count)) * rate[term]).astype(np.float32)
    weight /= np.sqrt(np.bincount(owner, weight.astype(float) ** 2, len(names)))[owner]
    some = np.flatnonzero(size)
    # like examples share a block: by label, then by the word of most weight
    heaviest = np.zeros(len(names), np.int64)
    if len(term):
        by_weight = np.lexsort((weight, owner))
        heaviest[some] = term[by_weight[first[some + 1] - 1]]
        del by_weight
    ranked = some[np.lexsort((names[some], heaviest[some], labels[some]))]
    place = np.full(len(names), -1, np.int32)
    place[ranked] = np.arange(len(ranked))
    n, blocks = len(ranked), -(-len(ranked) // BLOCK)
    order = np.lexsort((place[owner], term))
    posting, example = term[order], place[owner[order]]
    index = Index(terms, rate, names[ranked], labels[ranked].astype(float),
                  np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32),
                  np.zeros(0, np.int64), example, weight[order], np.zeros(0, np.int64),
                  np.zeros((0, blocks), np.float32), np.zeros((0, n), np.float32), prior, k, pull)
    del order, owner
    block = example // BLOCK
    new = np.ones(len(posting), bool)
    new[1:] = (posting[1:] != posting[:-1]) | (block[1:] != block[:-1])
    lead = np.flatnonzero(new)
    index.block, index.first = block[lead], np.append(lead, len(posting))
    index.most = (np.maximum.reduceat(index.weight, lead) if len(lead)
                  else np.zeros(0, np.float32))
    index.entry = np.searchsorted(posting[lead], np.arange(len(terms) + 1))
    often = np.bincount(posting, minlength=len(terms))
    common = np.sort(np.argsort(-often, kind="stable")[:COMMON])
    common = common[often[common] > LONG]
    index.long = np.full(len(terms), -1, np.int32)
    index.long[common] = np.arange(len(common))
    index.ceiling = np.zeros((len(common), blocks), np.float32)
    index.shared = np.zeros((len(common), blocks * BLOCK), np.float32)
    at = np.flatnonzero(index.long[posting] >= 0)
    index.shared[index.long[posting[at]], example[at]] = index.weight[at]
    at = np.flatnonzero(index.long[posting[lead]] >= 0)
    index.ceiling[index.long[posting[lead[at]]], index.block[at]] = index.most[at]
    # leave-one-out votes; an example without a word has the prior's
    cut = np.append(first[some], first[-1])
    votes = np.full(len(names), prior)
    votes[some] = [index.vote(*found) for found in index.nearest(cut, term, weight, place[some])]
    by_name = np.argsort(names, kind="stable")
    index.slope, index.shift = _platt(votes[by_name], labels[by_name].astype(float), prior)
    return index


def _platt(votes: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic fit of labels on votes by Newton steps, with a small ridge; rising."""
    a, b = 8.0, -8.0 * 0.5
    if len(labels) == 0 or labels.min() == labels.max():
        return 1.0, float(np.log(prior / (1 - prior)) - prior)
    x = np.column_stack((votes, np.ones(len(votes))))
    w = np.array([a, b])
    ridge = 0.02 * np.diag([1.0, 0.1])
    for _ in range(40):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (p - labels) + ridge @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w - np.clip(np.linalg.solve(hessian, gradient), -4, 4)
    return max(float(w[0]), 0.1), float(w[1])


def telling(n: np.ndarray, k: np.ndarray, rows: int, positive: int) -> np.ndarray:
    """How much words tell about the label, from FLOOR to 1: n examples, k with the label."""
    share = min(max(positive / max(rows, 1), 1e-9), 1 - 1e-9)
    p = k / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = n * (np.where(p > 0, p * np.log(p / share), 0.0)
                    + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - share)), 0.0))
    return FLOOR + (1 - FLOOR) * gain / (gain + HALF)


def document_counts(docs: DataFrame, terms: np.ndarray, text_col: str = "text"
                    ) -> tuple[int, np.ndarray]:
    """(number of rows, rows that hold each of the sorted word hashes), over all rows.

    Every task counts into one array over the terms, so what is exchanged is at
    most a row per term and task.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(terms)   # words of the bounded sample

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number, rows = np.zeros(len(known) + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for w in W.chunks(batch.column(0)):
                _, h, _ = term_counts(w)
                at = np.searchsorted(known, h)
                hit = at < len(known)
                hit[hit] = known[at[hit]] == h[hit]
                number += np.bincount(at[hit], minlength=len(number))
        number[-1] = rows
        some = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(number[some])],
                                         names=["term", "n"])

    got = (docs.select(text_col).mapInArrow(count, "term long, n long").groupBy("term")
           .agg(F.sum("n").alias("n")).toArrow())
    number = np.zeros(len(terms) + 1, np.int64)
    number[got["term"].to_numpy()] = got["n"].to_numpy()
    return int(number[-1]), number[:-1]


def fit(labelled: DataFrame, docs: DataFrame | None = None, *, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "label", k: int = 16) -> Index:
    """Index a bounded sample of labelled rows (the caller bounds its row count).

    Rows with a null label are left out.  Document frequencies are counted
    over all of ``docs`` (over the sample where there is none).  The driver
    receives the words of the sampled rows, whole, and one count per word.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for w in W.chunks(batch.column("text")):
            owner, h, count = term_counts(w)
            cut = np.searchsorted(owner, np.arange(w.hi - w.lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id")[w.lo:w.hi], batch.column("label")[w.lo:w.hi],
                 pa.ListArray.from_arrays(cut, pa.array(h.view(np.int64))),
                 pa.ListArray.from_arrays(cut, pa.array(count.astype(np.int32)))],
                names=["id", "label", "terms", "counts"])

    got = map_batches(rows, extract,
                      "id string, label int, terms array<long>, counts array<int>").toArrow()
    lists, numbers = (got[c].combine_chunks() for c in ("terms", "counts"))
    names = np.array(got["id"].to_pylist(), object)
    labels = got["label"].to_numpy().astype(np.int64)
    size = lists.value_lengths().to_numpy()
    flat, count = (x.flatten().to_numpy(zero_copy_only=False) for x in (lists, numbers))
    del got, lists, numbers
    terms, term = np.unique(flat.view(np.uint64), return_inverse=True)
    term = term.astype(np.int32)
    n = np.bincount(term, minlength=len(terms))
    with_label = np.bincount(term, np.repeat(labels, size), len(terms))
    total, often = document_counts(labelled if docs is None else docs, terms, text_col)
    rate = (np.log(1.0 + max(total, len(names)) / np.maximum(often, n))
            * telling(n, with_label, len(names), int(labels.sum())))
    first = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    return build(names, labels, first, term, count, terms, rate, k)


def score_texts(column: pa.Array, index: Index, evidence: int = 3
                ) -> tuple[np.ndarray, list[str]]:
    """(calibrated scores, evidence as ``id:label:cosine`` of the nearest examples)."""
    votes, notes = np.full(len(column), index.prior), [""] * len(column)
    for w in W.chunks(column):
        first, term, weight = index.vectors(*term_counts(w), w.hi - w.lo)
        for i, (found, near) in enumerate(index.nearest(first, term, weight)):
            votes[w.lo + i] = index.vote(found, near)
            notes[w.lo + i] = ",".join(
                f"{index.ids[e]}:{int(index.labels[e])}:{s:.3f}"
                for e, s in zip(found[:evidence], near[:evidence], strict=True))
    return index.calibrated(votes), notes


def score(docs: DataFrame, index: Index, *, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, score, predicted, evidence) of every row, over whole texts.

    Null and empty texts, and texts that share no word with an example, get the
    score of the prior.  Repeated rows are scored alike and stay repeated; other
    columns are ignored; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded rows and terms
    columns = [id_col, *(c for c in keep if c != id_col)]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s, notes = score_texts(batch.column(len(columns)), shared.value)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(len(columns))), pa.array(s),
             pa.array((s >= threshold).astype(np.int32)), pa.array(notes, pa.string())],
            names=[*columns, "score", "predicted", "evidence"])

    schema = ", ".join(f"`{c}` {kind(docs, c)}" for c in columns)
    text = F.col(text_col).alias(fresh(docs, "scored_text")[0])
    return map_batches(docs.select(*columns, text), run,
                       f"{schema}, score double, predicted int, evidence string")


def drop_toxic(docs: DataFrame, index: Index, *, text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """The rows scored below ``threshold``, with all their columns.

    Null and empty texts have the score of the prior; repeated rows are scored
    alike, so all or none of them stay; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded rows and terms
    where = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s, _ = score_texts(batch.column(where), shared.value, 0)
        yield batch.filter(pa.array(s < threshold))

    return map_batches(docs, run, ", ".join(f"`{c}` {kind(docs, c)}" for c in docs.columns))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Up to ``max_rows`` rows with a toxicity label, outside the held-out fifth.

    Chosen by lowest id hash, so the same rows at every run.
    """
    known = (labels.where((id_hash_mod("doc_id", 5) != 0) & F.col("toxic").isNotNull())
             .select("doc_id", F.col("toxic").alias("label"))
             .orderBy(F.xxhash64(F.col("doc_id").cast("string"))).limit(max_rows))
    return docs.select("doc_id", "text").join(known, "doc_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: toxicity of all documents, learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    index = fit(labelled_sample(docs, table(spark, sf_dir, "labels"), MAX_EXAMPLES), docs)
    return score(docs, index).select(
        "doc_id", (id_hash_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted",
        "evidence")
