"""Substring dedup by seed and extend: passages that an earlier document holds too.

A passage of ``least`` words is repeated if its words also start somewhere in
a document of a smaller id.  Seeds are winnowed anchors: of the ``SEED``-word
runs inside each passage the one of least hash is its anchor, so equal
passages always share theirs, and neighbouring passages mostly share one
anchor.  The passages of one anchor in one document are consecutive: together
they are the anchor extended both ways as far as it leads, its stretch.

Documents are joined on anchors; those in one document only end there.  Where
documents share an anchor, equal stretches are repeats as a whole: each such
class keeps its first document.  What remains is one stretch per class, and
only where an anchor has several classes, which agree around the seed and
then part: these are extended word by word, that is, the passages around the
anchor at each offset are compared.  Neighbouring repeats are merged into
maximal ones.  Every step groups by content and takes the least id, so no
pairs are made within a group, however many documents share a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import kind, map_batches, saved, table
from .texts import slices
from .words import _P, _P_INVERSE, mix

#: Words of the shortest repeat, and of a seed.
LEAST, SEED = 50, 10
_hash_word = xxhash.xxh3_64_intdigest


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_P, _P_INVERSE):
        factors = np.full(n + 1, base, dtype=np.uint64)
        factors[0] = 1
        made.append(np.multiply.accumulate(factors))
    return made[0], made[1]


class Hashes:
    """Word hashes of some texts one after the other, and of any stretch of them."""

    def __init__(self, texts: list[str]) -> None:
        # bytes.split() parts at exactly space, \t, \n, \v, \f and \r
        words = [t.encode().split() for t in texts]
        self.first = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
        n = int(self.first[-1])
        flat = np.fromiter((_hash_word(x) for w in words for x in w), np.uint64, n)
        power, self.inverse = _powers(n)
        self.sums = np.concatenate((np.zeros(1, np.uint64),
                                    np.cumsum(flat * power[:n], dtype=np.uint64)))

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of the stretches of ``length`` words from ``start``; equal words, equal hash."""
        poly = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
        return mix(poly + np.asarray(length, np.uint64))


def stretches(hashes: Hashes, least: int, seed: int) -> tuple[np.ndarray, ...]:
    """(text, first passage, number of passages, anchor) of every stretch.

    Passages are counted by their first word within the text; the anchor is
    the position of its first word among all words.
    """
    first = hashes.first
    n = int(first[-1])
    count = np.maximum(np.diff(first) - least + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = first[text] + within
    seeds = hashes.of(np.arange(n - seed + 1), seed)
    view = np.lib.stride_tricks.sliding_window_view(seeds, least - seed + 1)
    anchor = np.empty(len(start), np.int64)
    for lo in range(0, len(start), 1 << 16):
        at = start[lo:lo + (1 << 16)]
        # the leftmost least hash: its place in the passage depends on its words alone
        anchor[lo:lo + (1 << 16)] = at + view[at].argmin(axis=1)
    new = np.ones(len(start), bool)
    new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
    lead = np.flatnonzero(new)
    return text[lead], within[lead], np.diff(np.append(lead, len(start))), anchor[lead]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, text): a document is its id and its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"),
                       text.alias("text"))


def runs(keyed: DataFrame, least: int, seed: int) -> DataFrame:
    """(anchor, stretch, id, text_key, start, number) of every stretch of every document."""
    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, _, texts in slices(batch.column(2), 1 << 20):
            hashes = Hashes(texts)
            text, start, number, anchor = stretches(hashes, least, seed)
            whole = hashes.of(hashes.first[text] + start, number + least - 1)
            at = pa.array(lo + text)
            yield pa.RecordBatch.from_arrays(
                [_signed(hashes.of(anchor, seed)), _signed(whole), batch.column(0).take(at),
                 batch.column(1).take(at), pa.array(start.astype(np.int32)),
                 pa.array(number.astype(np.int32))],
                names=["anchor", "stretch", "id", "text_key", "start", "number"])
    return map_batches(keyed, make, f"anchor long, stretch long, id {kind(keyed, 'id')}, "
                                    "text_key long, start int, number int")


def passages(keyed: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(anchor, passage, stretch, offset, id) of every passage of the wanted stretches."""
    lists = saved(wanted.groupBy(F.col("id").alias("w_id"), F.col("text_key").alias("w_key")).agg(
        F.collect_list(F.struct("anchor", "stretch", "start", "number")).alias("wanted")), "wanted")
    # equal rows hold the same passages: their ids are no smaller than each other's
    texts = keyed.join(lists, (keyed["id"] == lists["w_id"])
                       & (keyed["text_key"] == lists["w_key"])).select("id", "text", "wanted")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked = batch.column(2)
        for lo, hi, texts in slices(batch.column(1), 1 << 20):
            hashes = Hashes(texts)
            part = asked.slice(lo, hi - lo)
            flat = part.flatten()
            text = np.repeat(np.arange(hi - lo), part.value_lengths().to_numpy())
            start, number = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "number"))
            row = np.repeat(np.arange(len(text)), number)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            at = hashes.first[text[row]] + start[row] + offset
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [flat.field("anchor").take(take), _signed(hashes.of(at, least)),
                 flat.field("stretch").take(take), pa.array(offset.astype(np.int32)),
                 batch.column(0).take(pa.array(lo + text[row]))],
                names=["anchor", "passage", "stretch", "offset", "id"])
    return map_batches(texts, make, "anchor long, passage long, stretch long, offset int, "
                                    f"id {kind(keyed, 'id')}")


def repeats(docs: DataFrame, *, least: int = LEAST, seed: int = SEED,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, found): stretches of each document with passages an earlier one holds.

    ``found`` lists (start, number, offsets): the passages at these offsets
    from ``start`` are repeated, all ``number`` of them where ``offsets`` is
    null.  Null ids are smaller than none, so their rows neither lose nor
    take anything; rows of equal id take nothing from each other.
    """
    keyed = _keyed(docs, id_col, text_col).where("id is not null")
    every = saved(runs(keyed, least, seed), "stretches")
    # what is joined with many rows of one key is written first: an aggregate
    # in the join's own stage would keep Spark from splitting that key
    shared = saved(every.groupBy(F.col("anchor").alias("shared"))
                   .agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
                   .select("shared"), "shared-anchors")
    some = saved(every.join(shared, every["anchor"] == shared["shared"], "left_semi"),
                 "shared-stretches")
    # one class per content; its first document answers for the others
    classes = saved(some.groupBy("anchor", "stretch").agg(
        F.min(F.struct("id", "text_key", "start", "number")).alias("first")), "classes")
    several = saved(classes.groupBy(F.col("anchor").alias("several")).agg(F.count("*").alias("n"))
                    .where("n > 1").select("several"), "parting-anchors")
    wanted = classes.join(several, classes["anchor"] == several["several"], "left_semi").select(
        "anchor", "stretch", "first.*")
    tried = saved(passages(keyed, wanted, least).distinct(), "passages")
    earliest = saved(tried.groupBy(F.col("anchor").alias("e_anchor"),
                                   F.col("passage").alias("e_passage"))
                     .agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi"),
                     "repeated-passages")
    partly = (tried.join(earliest, (tried["anchor"] == earliest["e_anchor"])
                         & (tried["passage"] == earliest["e_passage"])
                         & (earliest["lo"] < tried["id"]))
              .groupBy("anchor", "stretch").agg(F.sort_array(F.collect_list("offset"))
                                                .alias("offsets")))
    verdicts = saved(classes.join(partly, ["anchor", "stretch"], "left")
                     .select(F.col("anchor").alias("v_anchor"), F.col("stretch").alias("v_stretch"),
                             F.col("first.id").alias("first_id"), "offsets"), "verdicts")
    judged = some.join(verdicts, (some["anchor"] == verdicts["v_anchor"])
                       & (some["stretch"] == verdicts["v_stretch"])
                       & ((verdicts["first_id"] < some["id"]) | verdicts["offsets"].isNotNull()))
    return saved(judged.groupBy("id", "text_key").agg(F.collect_set(F.struct(
        "start", "number", F.when(F.col("first_id") < F.col("id"), F.lit(None))
        .otherwise(F.col("offsets")).alias("offsets"))).alias("found")), "repeats")


def _spans(found: list[dict], least: int) -> list[tuple[int, int]]:
    """Maximal repeats (first word, word after): the found passages, merged."""
    parts = sorted((f["start"] + lo, f["start"] + hi + least) for f in found
                   for lo, hi in ([(0, f["number"] - 1)] if f["offsets"] is None
                                  else [(o, o) for o in f["offsets"]]))
    spans: list[list[int]] = []
    for lo, hi in parts:
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(hi, spans[-1][1])
        else:
            spans.append([lo, hi])
    return [(lo, hi) for lo, hi in spans]


def remove(docs: DataFrame, *, least: int = LEAST, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, text, n_words, repeats) of every row: its kept words, joined by one space.

    ``repeats`` are the maximal repeats (start, end) that were removed, in
    words of the original.  Null and empty texts have no words and become
    empty; repeated rows stay repeated; rows without an id are kept whole;
    other columns are ignored; an empty table gives an empty one.
    """
    keyed = _keyed(docs, id_col, text_col)
    found = repeats(docs, least=least, seed=seed, id_col=id_col, text_col=text_col).select(
        F.col("id").alias("r_id"), F.col("text_key").alias("r_key"), "found")
    rows = keyed.join(found, (keyed["id"] == found["r_id"]) & (keyed["text_key"] == found["r_key"]),
                      "left").select("id", "text", "found")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, texts in slices(batch.column(1)):
            kept, number, removed = [], [], []
            for text, runs_ in zip(texts, batch.column(2)[lo:hi].to_pylist(), strict=True):
                words = text.encode().split()
                spans = _spans(runs_ or [], least)
                number.append(len(words))
                removed.append([{"start": a, "end": b} for a, b in spans])
                for a, b in reversed(spans):
                    del words[a:b]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], pa.array(kept, pa.string()), pa.array(number, pa.int64()),
                 pa.array(removed, span)], names=[id_col, text_col, "n_words", "repeats"])
    return map_batches(rows, make, f"`{id_col}` {kind(docs, id_col)}, `{text_col}` string, "
                                   "n_words long, repeats array<struct<start:int,end:int>>")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: words of all documents less the passages that earlier ones hold."""
    gone = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]))
    return remove(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", gone.alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))
