"""Benchmark decontamination: counted word pairs, then Smith-Waterman alignment.

The score is the best local alignment's share of the item's full score
(match 2, mismatch -1, gap -1): edited and paraphrased copies keep most of it.
A long passage with few edits is a hit also where it is a small part of its item.
What is aligned is chosen by a bound, so no pair above the threshold is missed.

Between two matched words that follow each other, an alignment loses one
point for every word of the longer side.  It scores two for the first match,
and for each later one two less what the step to it lost; so steps that lose
less than two points make up all of the score but two.  Such a step starts at
a pair of words that are next to each other, or one word apart, in the item
and in the text.  Pairs are counted in all documents first; the steps of an
item that start at its commonest pairs are left out, and what they could have
scored is taken off the points asked for.  A second pass adds up the points
of the pairs of each document and item, and aligns the item with the
stretches where enough are close together.

The seeds are thus rare pairs of words rather than longer rare runs: a copy
edited at every few words keeps no longer run, and the bound holds for pairs.
Items are taken in blocks of bounded size, so what is broadcast is bounded
however large the benchmark is; every block meets all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .frames import fresh, kind, map_batches, saved, ship, table

MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: Items of fewer words are found as a whole run only, word for word.
WHOLE = 5
#: Bytes of test items that are searched at once.
BLOCK_BYTES = 4 << 20
#: A passage of so many item words, word for word, is a hit whatever the item's
#: length; every edit in it asks for EDIT_COST words more.
PASSAGE, EDIT_COST = 13, 4
#: Leading bits of a hash by which most of the other pairs are passed over.
TABLE_BITS = 20


@dataclass
class Block:
    """Words of a block of items, and their seeds once those are chosen."""

    ids: list
    words: list[np.ndarray]
    pairs: np.ndarray          # sorted distinct pair hashes of all items
    least: np.ndarray          # of each item: the least score that is a hit
    need: np.ndarray           # of each item: the points asked of its seeds
    seeds: np.ndarray          # sorted seed hashes
    first: np.ndarray          # of each seed: its first place, and one more
    item: np.ndarray           # places: item, and whether its words are neighbours
    near: np.ndarray
    table: np.ndarray          # whether a seed's hash begins with these bits
    single: bool               # words of some items are seeds, too


def _chunks(column: pa.Array) -> Iterator[W.Words]:
    """``words.chunks``, with every character of a script without spaces a word."""
    return map(_characters, W.chunks(column))


def _characters(w: W.Words) -> W.Words:
    """Words cut around each Han, Kana, Thai, Lao, Burmese or Khmer character."""
    at = np.flatnonzero(w.data >= 0xE0)
    if not len(at) or not len(w.start):
        return w
    lead, second = w.data[at], w.data[at + 1]
    unspaced = ((lead >= 0xE3) & (lead <= 0xE9)
                | (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
                | (lead == 0xE1) & ((second <= 0x82) | (second == 0x9E) | (second == 0x9F))
                | (lead == 0xEF) & ((second >= 0xA4) & (second <= 0xAB) | (second == 0xBE)
                                    | (second == 0xBD) & (w.data[at + 2] >= 0xA6))
                | (lead == 0xF0) & (second >= 0xA0) & (second <= 0xB3))
    at, size = at[unspaced], 3 + (lead[unspaced] == 0xF0)
    word = np.searchsorted(w.start, at, "right") - 1
    inside = (word >= 0) & (at < w.end[word])
    at, size, word = at[inside], size[inside], word[inside]
    if not len(at):
        return w
    start = np.unique(np.concatenate((w.start, at, (at + size)[at + size < w.end[word]])))
    end = np.unique(np.concatenate((w.end, at + size, at[at > w.start[word]])))
    first = np.append(np.searchsorted(start, w.start), len(start))[w.first]
    return replace(w, start=start, end=end, first=first, hash=W.hashes(w.data, start, end))


def read_block(items: list[tuple[object, str | None]], threshold: float = THRESHOLD,
               min_words: int = 1) -> Block:
    """Words and pairs of (id, text) items of ``min_words`` or more."""
    ids, words = [], []
    if items:
        for w in _chunks(pa.array([t for _, t in items], pa.large_string())):
            for i in range(w.hi - w.lo):
                h = w.hash[w.first[i]:w.first[i + 1]]
                if len(h) >= min_words:
                    ids.append(items[w.lo + i][0])
                    words.append(h)
    pairs = (np.unique(np.concatenate([_pairs(h, d) for h in words for d in (1, 2)]))
             if words else np.zeros(0, np.uint64))
    length = np.array([len(h) for h in words], np.int64)
    least = np.ceil(MATCH * threshold * length - 1e-9).astype(np.int64)
    least = np.clip(least, 1, MATCH * PASSAGE)          # a passage scores as much at least
    least = np.where(length < WHOLE, MATCH * length, least)
    none = np.zeros(0, np.int64)
    return Block(ids, words, pairs, least, none, np.zeros(0, np.uint64), np.zeros(1, np.int64),
                 none, none.astype(bool), np.zeros(1 << TABLE_BITS, bool), False)


def _pairs(h: np.ndarray, distance: int) -> np.ndarray:
    """Hashes of the pairs of words that are ``distance`` apart."""
    return W.mix(h[:-distance] * W._C + h[distance:])


def choose_seeds(block: Block, frequency: np.ndarray) -> None:
    """Seeds of every item: all its pairs but those of its commonest starts.

    A start left out could have scored two points; half the points that a hit
    must have stay asked of the others.  An item that may score without any
    pair has its words as seeds.
    """
    seeds, items, nears, need = [], [], [], []
    for i, h in enumerate(block.words):
        points = int(block.least[i]) - MATCH
        if points < 1:
            seeds.append(h)
            items.append(np.full(len(h), i))
            nears.append(np.zeros(len(h), bool))
            need.append(1)
            block.single = True
            continue
        near, far = _pairs(h, 1), _pairs(h, 2)
        often = frequency[np.searchsorted(block.pairs, near)]
        often[:-1] += frequency[np.searchsorted(block.pairs, far)]
        skipped = points // 4
        keep = np.sort(np.argsort(often, kind="stable")[:len(near) - skipped])
        far = far[keep[keep < len(far)]]
        seeds += [near[keep], far]
        items.append(np.full(len(keep) + len(far), i))
        nears += [np.ones(len(keep), bool), np.zeros(len(far), bool)]
        need.append(points - MATCH * skipped)
    if not seeds:
        return
    seed = np.concatenate(seeds)
    order = np.argsort(seed, kind="stable")
    block.seeds, count = np.unique(seed, return_counts=True)
    block.first = np.concatenate(([0], np.cumsum(count)))
    block.item, block.near = np.concatenate(items)[order], np.concatenate(nears)[order]
    block.need = np.array(need)
    block.table = _table(block.seeds)


def _table(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << TABLE_BITS, bool)
    out[keys >> np.uint64(64 - TABLE_BITS)] = True
    return out


def _found(keys: np.ndarray, table: np.ndarray, hashes: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """(index into hashes, index into keys) of the hashes that are among the sorted keys."""
    maybe = np.flatnonzero(table[hashes >> np.uint64(64 - TABLE_BITS)])
    at = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
    same = keys[at] == hashes[maybe]
    return maybe[same], at[same]


def _text_pairs(w: W.Words, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the pairs of words that are ``distance`` apart in one text."""
    if len(w.hash) <= distance:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(w.hi - w.lo), np.diff(w.first))
    start = np.flatnonzero(text[distance:] == text[:-distance])
    return _pairs(w.hash, distance)[start], start


def align(item: np.ndarray, text: np.ndarray, match: int = MATCH, mismatch: int = MISMATCH,
          gap: int = GAP) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: (score, matched words, start, end in text).

    Ties go to the earliest end in the item, then in the text.  Horizontal
    gaps of a row are resolved at once by a running maximum.
    """
    n, m = len(item), len(text)
    score = np.zeros((n + 1, m + 1), np.int32)
    ramp = np.arange(m + 1, dtype=np.int32) * -gap
    for i in range(n):
        step = np.where(text == item[i], match, mismatch)
        row = np.maximum(score[i] + gap, 0)
        np.maximum(row[1:], score[i, :-1] + step, out=row[1:])
        score[i + 1] = np.maximum.accumulate(row + ramp) - ramp
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    best, matched, end = int(score[i, j]), 0, int(j)
    while i > 0 and j > 0 and score[i, j] > 0:
        same = item[i - 1] == text[j - 1]
        if score[i, j] == score[i - 1, j - 1] + (match if same else mismatch):
            matched += int(same)
            i, j = i - 1, j - 1
        elif score[i, j] == score[i - 1, j] + gap:
            i -= 1
        else:
            j -= 1
    return best, matched, int(j), end


def _stretches(place: np.ndarray, reach: int, most: int) -> Iterator[tuple[int, int]]:
    """Unions of the stretches within ``reach`` of ascending places, to about ``most`` words."""
    start, end = None, None
    for p in place.tolist():
        a, b = p - reach, p + reach
        if start is None:
            start, end = a, b
        elif a <= end and b - start <= most:
            end = b
        else:
            yield start, end
            start, end = a, b
    if start is not None:
        yield start, end


def _candidates(w: W.Words, block: Block, reach: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, text, word) where as many points as an item needs begin within its reach."""
    items, places, points = [], [], []
    for distance in (1, 2, 0) if block.single else (1, 2):
        hashes, start = (_text_pairs(w, distance) if distance
                         else (w.hash, np.arange(len(w.hash))))
        hit, at = _found(block.seeds, block.table, hashes)
        size = np.diff(block.first)[at]
        index = np.arange(size.sum()) + np.repeat(block.first[at] - (np.cumsum(size) - size), size)
        items.append(block.item[index])
        places.append(np.repeat(start[hit], size))
        points.append(block.near[index] + 1 if distance == 1 else np.ones(len(index), np.int64))
    item, place, point = map(np.concatenate, (items, places, points))
    none = np.zeros(0, np.int64)
    if not len(item):
        return none, none, none
    key = (item << 40) | (place << 2) | point
    key.sort()
    last = np.append(key[1:] >> 2 != key[:-1] >> 2, True)      # a word starts one step: its best
    key = key[last]
    item, place, point = key >> 40, (key >> 2) & ((1 << 38) - 1), key & 3
    text = np.searchsorted(w.first, place, "right") - 1
    new = np.append(True, (item[1:] != item[:-1]) | (text[1:] != text[:-1]))
    group = np.cumsum(new) - 1
    total = np.bincount(group, point)
    some = total[group] >= block.need[item]
    item, place, point, text, group = item[some], place[some], point[some], text[some], group[some]
    spot = (group << 38) + place
    upto = np.searchsorted(spot, spot + reach[item])
    summed = np.concatenate(([0], np.cumsum(point)))
    some = summed[upto] - summed[:-1] >= block.need[item]
    return item[some], text[some], place[some]


def find(w: W.Words, block: Block, threshold: float
         ) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(text, item, score, matched words, first word, word after) of a chunk's best hits."""
    if not len(block.seeds) or not len(w.hash):
        return
    # a word of text beyond the item's costs a point, and so does one that doesn't match
    length = np.array([len(h) for h in block.words], np.int64)
    reach = np.maximum(length, 3 * length - block.least)
    item, text, place = _candidates(w, block, reach)
    if not len(item):
        return
    new = np.append(True, (item[1:] != item[:-1]) | (text[1:] != text[:-1]))
    cuts = np.append(np.flatnonzero(new), len(text))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        t, i = int(text[a]), int(item[a])
        wanted = block.words[i]
        doc = w.hash[w.first[t]:w.first[t + 1]]
        best = None
        for start, end in _stretches(place[a:b] - w.first[t], int(reach[i]), 8 * len(wanted)):
            start, end = max(0, start), min(len(doc), end)
            # words in common bound the score from above
            there = int(np.isin(wanted, doc[start:end]).sum())
            if MATCH * there < block.least[i]:
                continue
            score, matched, first, last = align(wanted, doc[start:end])
            share = score / (MATCH * len(wanted))
            if len(wanted) < WHOLE:
                if score < block.least[i]:
                    continue
            elif share < threshold:
                points, matched, first, last = align(wanted, doc[start:end], 1, -EDIT_COST,
                                                     -EDIT_COST)
                if points < PASSAGE:
                    continue
                edits = (matched - points) // EDIT_COST
                share = (MATCH * matched - edits) / (MATCH * len(wanted))
            if best is None or share > best[0]:
                best = (share, matched, start + first, start + last)
        if best:
            yield (w.lo + t, i, *best)


def _pair_counts(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each pair of the block occurs in all documents."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(block.pairs)  # bounded by BLOCK_BYTES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value
        table = _table(pairs)
        number = np.zeros(len(pairs), np.int64)
        for batch in batches:
            for w in _chunks(batch.column(0)):
                for distance in (1, 2):
                    _, at = _found(pairs, table, _text_pairs(w, distance)[0])
                    number += np.bincount(at, minlength=len(pairs))
        some = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(number[some])],
                                         names=["pair", "number"])

    out = np.zeros(len(block.pairs), np.int64)
    if len(out):
        got = (docs.select("text").mapInArrow(count, "pair long, number long")
               .groupBy("pair").agg(F.sum("number").alias("number")).toArrow())
        out[got["pair"].to_numpy()] = got["number"].to_numpy()
    return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int,
           threshold: float = THRESHOLD, min_words: int = 1) -> Iterator[Block]:
    """The items in blocks of about ``block_bytes`` bytes, chosen by hash."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = part.collect()                      # about ``block_bytes`` of items
        yield read_block(sorted(((r["id"], r["text"]) for r in rows),
                                key=lambda r: (r[0] is None, r[0])), threshold, min_words)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES,
                 min_words: int = 1) -> DataFrame:
    """(id, item id, score, matched_words, start_word, end_word) of documents that hold an item.

    One row per document row and item whose best alignment reaches
    ``threshold`` of the item's full score, or else whose best passage has
    PASSAGE words matched after EDIT_COST are taken off for every edit; its
    score is the passage's share, below ``threshold``.  Items of fewer than WHOLE
    words are found where all their words follow each other; those of fewer
    than ``min_words``, null and empty ones find nothing, as do null and empty
    texts; in scripts without spaces every character is a word.  Equal items and
    repeated rows are all reported; other columns are ignored; empty tables
    give an empty result.
    """
    return _hits(docs, benchmark, id_col, text_col, item_col, item_text, threshold,
                 block_bytes, min_words).drop("text_hash")


def _hits(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str,
          item_text: str, threshold: float, block_bytes: int, min_words: int) -> DataFrame:
    """The rows of ``contaminated`` with the hash of each document's text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    schema = (f"id {kind(docs, id_col)}, item {kind(benchmark, item_col)}, score double, "
              "matched_words int, start_word int, end_word int, text_hash long")
    item_type = benchmark.select(item_col).limit(0).toArrow().schema.field(0).type
    parts = []
    for block in blocks(benchmark, item_col, item_text, block_bytes, threshold, min_words):
        choose_seeds(block, _pair_counts(rows, block))
        shared = docs.sparkSession.sparkContext.broadcast(block)    # bounded by block_bytes

        def search(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            use = shared.value
            for w in _chunks(batch.column("text")):
                hits = list(find(w, use, threshold))
                if hits:
                    row, item, *rest = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(row)),
                         pa.array([use.ids[i] for i in item], item_type),
                         pa.array(rest[0], pa.float64()),
                         *(pa.array(c, pa.int32()) for c in rest[1:]),
                         batch.column("text_hash").take(pa.array(row))],
                        names=["id", "item", "score", "matched_words", "start_word", "end_word",
                               "text_hash"])

        parts.append(saved(map_batches(rows, search, schema), "contaminated"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score",
                      "matched_words", "start_word", "end_word", "text_hash")


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES,
          min_words: int = 1) -> DataFrame:
    """The rows that ``contaminated`` doesn't find, with all their columns.

    A row is known by its id and its text's hash, so other rows of a null or
    repeated id stay.
    """
    found = _hits(docs, benchmark, id_col, text_col, item_col, item_text, threshold, block_bytes,
                  min_words)
    bad_id, bad_hash = fresh(docs, "bad_id", "bad_hash")
    bad = found.select(F.col(id_col).alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(bad_id))
                     & (F.xxhash64(text_col) == F.col(bad_hash)), "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all documents that hold a benchmark item, with the alignment."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
