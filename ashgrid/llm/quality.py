"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

Tokens are runs of letters and digits, or runs of other visible signs.  A
text's features are its hashed one- and two-token runs, where a run that
repeats its own first token counts as the one feature "repeat", a token written in
capitals also counts as "capitals", and a three-token run seen earlier in the
same text counts as "again".  Values are 1 + ln(count), scaled to unit
length, so a text of any length has the same weight.

The weights are learned with follow-the-regularised-leader (proximal, per
coordinate rates) from a bounded sample of labelled rows; a text's score is
the logistic function of the sparse dot product of features and weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .frames import id_hash_mod, kind, map_batches, table

BITS = 18
_REPEAT, _CAPITALS, _AGAIN, _SKIP = (np.uint64(x) for x in (0x51, 0x52, 0x53, 0x54))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[:33] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, is all capitals, first token of each text) over a chunk of raw bytes."""
    n = len(data)
    lower = np.where(_UPPER[data], data + np.uint8(32), data)
    group = np.where(_SPACE[data], 0, np.where(W._WORD[lower], 1, 2)).astype(np.int8)
    change = np.empty(n + 1, dtype=bool)
    change[0] = change[n] = True
    change[1:n] = group[1:] != group[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    start, end = edges[:-1], edges[1:]
    visible = group[start] > 0
    start, end = start[visible], end[visible]
    power, inverse = W._power_tables(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    ups = np.zeros(n + 1, np.int64)
    np.cumsum(_UPPER[data], out=ups[1:])
    length = end - start
    capitals = (length > 1) & (ups[end] - ups[start] == length)
    return (W.mix((prefix[end] - prefix[start]) * inverse[start]), capitals,
            np.searchsorted(start, offsets, "left"))


def features(column: pa.Array, bits: int = BITS
             ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: (lo, hi, index of each entry's text, hashed feature, unit-length value)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    all_offsets, all_data = W.utf8(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(all_offsets, all_offsets[lo] + W.CHUNK_BYTES,
                                             "right")) - 1)
        data = all_data[all_offsets[lo]:all_offsets[hi]]
        offsets = all_offsets[lo:hi + 1] - all_offsets[lo]
        yield (lo, hi, *_chunk_features(data, offsets, hi - lo, bits))
        lo = hi


def _chunk_features(data: np.ndarray, offsets: np.ndarray, texts: int, bits: int
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    h, capitals, first = _tokens(data, offsets)
    doc = np.repeat(np.arange(texts), np.diff(first))
    parts, owners = [h], [doc]
    parts.append(np.full(int(capitals.sum()), _CAPITALS))
    owners.append(doc[capitals])
    if len(h) > 1:
        same = doc[1:] == doc[:-1]
        two = W.mix(h[:-1] * W._C + h[1:])
        two[h[:-1] == h[1:]] = _REPEAT
        parts.append(two[same])
        owners.append(doc[:-1][same])
    if len(h) > 2:
        same = doc[2:] == doc[:-2]
        three = W.mix((h[:-2] * W._C + h[1:-1]) * W._C + h[2:])[same]
        owner = doc[:-2][same]
        apart = (h[:-2] == h[2:])[same]
        parts.append(np.full(int(apart.sum()), _SKIP))
        owners.append(owner[apart])
        order = np.lexsort((three, owner))
        again = np.zeros(len(order), dtype=bool)
        again[1:] = ((three[order][1:] == three[order][:-1])
                     & (owner[order][1:] == owner[order][:-1]))
        parts.append(np.full(int(again.sum()), _AGAIN))
        owners.append(owner[order][again])
    slot = W.mix(np.concatenate(parts)) >> np.uint64(64 - bits)
    key = (np.concatenate(owners).astype(np.uint64) << np.uint64(bits)) | slot
    key, count = np.unique(key, return_counts=True)
    owner = (key >> np.uint64(bits)).astype(np.int64)
    value = 1.0 + np.log(count)
    norm = np.sqrt(np.bincount(owner, value * value, texts))
    return owner, (key & np.uint64((1 << bits) - 1)).astype(np.int64), value / norm[owner]


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 4,
         alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05
         ) -> tuple[np.ndarray, float]:
    """FTRL-proximal logistic regression over (features, values, label) rows.

    Rows are taken in the given order, ``epochs`` times; both labels get the
    same total weight.  Returns the weights and the intercept.  Without rows,
    or with one label only, the weights are zero and the intercept says the
    label's share (pulled to a half by one row of each).
    """
    size = 1 << bits
    n_one = sum(y for _, _, y in rows)
    share = (n_one + 1) / (len(rows) + 2)
    bias = float(np.log(share / (1 - share)))
    if n_one in (0, len(rows)):
        return np.zeros(size), bias
    weight = (len(rows) / (2 * (len(rows) - n_one)), len(rows) / (2 * n_one))
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for index, value, label in rows:
            index = np.append(index, size)
            value = np.append(value, 1.0)
            zi, ni = z[index], n[index]
            w = np.where(np.abs(zi) <= l1, 0.0,
                         -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value * weight[label]
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[index] = ni + g * g
    w = np.where(np.abs(z) <= l1, 0.0,
                 -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w[:size], float(w[size])


@dataclass(frozen=True)
class QualityModel:
    """Hashed weights (non-zero ones only) and intercept of a fitted classifier."""

    bits: int
    index: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.index] = self.weight
        return out


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "label", max_rows: int = 6000, bits: int = BITS,
        epochs: int = 4) -> QualityModel:
    """Learn from at most ``max_rows`` labelled rows, those of lowest id hash.

    Rows with a null label are left out; a null text is an empty one.  Only
    hashed feature counts of that bounded sample reach the task that learns;
    learning runs in one task, since FTRL is sequential, and returns only the
    non-zero weights (at most 2^bits).
    """
    rank = F.xxhash64(F.col(id_col).cast("string"))
    sample = (labelled.where(F.col(label_col).isNotNull())
              .select(rank.alias("rank"), F.col(text_col).alias("text"),
                      F.col(label_col).cast("int").alias("label")))

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rank, label = batch.column("rank"), batch.column("label")
        for lo, hi, owner, slot, value in features(batch.column("text"), bits):
            cut = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rank[lo:hi], label[lo:hi],
                 pa.ListArray.from_arrays(cut, pa.array(slot, pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(value, pa.float32()))],
                names=["rank", "label", "slot", "value"])

    made = map_batches(sample, extract,
                       "rank long, label int, slot array<int>, value array<float>")
    made = made.orderBy("rank", "label", "slot").limit(max_rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            slots, values = batch.column("slot"), batch.column("value")
            for i in range(batch.num_rows):
                rows.append((slots[i].values.to_numpy(zero_copy_only=False).astype(np.int64),
                             values[i].values.to_numpy(zero_copy_only=False).astype(np.float64),
                             int(labels[i])))
        weight, bias = ftrl(rows, bits, epochs)
        at = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()),
             pa.array(np.append(weight[at], bias), pa.float64())], names=["slot", "weight"])

    out = made.coalesce(1).mapInArrow(learn, "slot long, weight double").toArrow()
    if not out.num_rows:
        return QualityModel(bits, np.zeros(0, np.int64), np.zeros(0), 0.0)
    slot, weight = out["slot"].to_numpy(), out["weight"].to_numpy()
    real = slot >= 0
    return QualityModel(bits, slot[real], weight[real], float(weight[~real][0]))


def score_texts(column: pa.Array, dense: np.ndarray, bits: int, intercept: float) -> np.ndarray:
    """Scores of a batch of texts (an empty text gets the intercept's)."""
    out = np.zeros(len(column))
    for lo, hi, owner, slot, value in features(column, bits):
        out[lo:hi] = np.bincount(owner, dense[slot] * value, hi - lo)
    return 1.0 / (1.0 + np.exp(-np.clip(out + intercept, -35, 35)))


def score(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id",
          text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, score, predicted) of every row; whole texts, other columns are ignored.

    Null and empty texts get the intercept's score.  Repeated rows are scored
    alike and stay repeated; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)   # at most 2^bits weights
    ready: dict[str, np.ndarray] = {}

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = shared.value
        if "w" not in ready:
            ready["w"] = m.dense()
        s = score_texts(batch.column(1), ready["w"], m.bits, m.intercept)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
            names=[id_col, "score", "predicted"])

    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind(docs, id_col)}, score double, predicted int")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: quality of all documents, learned outside the held-out quarter."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = (labels.where((id_hash_mod("doc_id", 4) != 2) & F.col("quality").isNotNull())
             .select("doc_id", F.col("quality").alias("label"))
             .orderBy(F.xxhash64(F.col("doc_id").cast("string"))).limit(6000))
    model = fit(docs.select("doc_id", "text").join(known, "doc_id"), max_rows=6000)
    return score(docs, model).select(
        "doc_id", (id_hash_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
