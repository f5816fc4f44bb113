"""N-gram Jaccard join: MinHash banding, then exact verification.

Texts become sets of hashed five-word runs.  Texts of equal sets are one
class of copies from then on.  Each class has a MinHash signature, cut into
bands; the number of bands and rows is chosen for a target recall at the
threshold.  A shuffle on band hashes gathers what agrees in a band, and only
a star of edges to the least member leaves each band, never its pairs.  The
components of these stars are the candidate groups.  In a group all pairs
are verified on full sets, in blocks: the block pairs of a larger group are
tasks of their own.  In a group of very many blocks only those pairs meet that
share one of some set's rarest runs, as an exact bound shows that others hold
no link.  The counts of common runs of a block pair are one
matrix product.  What leaves a task are link counts and the edges of a
spanning forest, so output grows with the documents.  The verified
components are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .frames import fresh, kind, map_batches, saved, ship, table

WORDS = 5
THRESHOLD = 0.8
#: Classes of one candidate group that are verified against each other at once;
#: a group of more is cut, and one of more than MANY times as many looks for blocks to skip.
BLOCK = 512
MANY = 64


def choose_bands(threshold: float, recall: float = 0.9999, most: int = 192) -> tuple[int, int]:
    """(bands, rows) of at most ``most`` hashes with the most rows that reach ``recall``.

    A pair at the threshold agrees in one of b bands of r rows with
    probability 1 - (1 - threshold^r)^b; more rows let fewer unlike pairs by.
    """
    for rows in range(most, 0, -1):
        agree = threshold ** rows
        bands = 1 if agree >= recall else math.ceil(math.log(1 - recall) / math.log1p(-agree))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding of so few hashes reaches the recall")


def _factors(n: int) -> np.ndarray:
    """Odd 32-bit multipliers, the same in every run."""
    x = W.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(W._P))
    return (x >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def band_hashes(grams: np.ndarray, bands: int, rows: int, factors: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature of a set of hashes."""
    low = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(low), 1024):
        np.minimum(least, (low[lo:lo + 1024, None] * factors).min(axis=0), out=least)
    table_ = least.astype(np.uint64).reshape(bands, rows)
    h = np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        h = W.mix(h * W._C + table_[:, r])
    return h.view(np.int64)


def gram_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(row, sorted distinct run hashes, 16-byte digest of that set) of each text."""
    for w in W.chunks(column):
        grams, offsets = w.grams(words)
        for i in range(w.hi - w.lo):
            distinct = np.unique(grams[offsets[i]:offsets[i + 1]])
            yield (w.lo + i, distinct,
                   hashlib.blake2b(distinct.tobytes(), digest_size=16).digest())


def _signed(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int
            ) -> DataFrame:
    """(id, text hash, set digest, band hashes) of every row; texts without words have no bands."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        factors = _factors(bands * rows)
        done: dict[bytes, np.ndarray] = {}
        keys, found = [], []
        for _, grams, key in gram_sets(batch.column(2), words):
            if key not in done:
                done[key] = (band_hashes(grams, bands, rows, factors) if len(grams)
                             else np.zeros(0, np.int64))
            keys.append(key)
            found.append(done[key])
        cut = np.concatenate(([0], np.cumsum([len(b) for b in found]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
             pa.ListArray.from_arrays(cut, pa.array(np.concatenate(found)))],
            names=["id", "text_hash", "key", "bands"])

    return map_batches(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                                   F.col(text_col).alias("text")), run,
                       f"id {kind(docs, id_col)}, text_hash long, key binary, bands array<long>")


def _candidates(classes: DataFrame) -> DataFrame:
    """(key, part) of the classes that share a band with another: the candidate groups."""
    each = classes.select("key", F.explode("bands").alias("band"))
    least = (each.groupBy("band").agg(F.min("key").alias("low"), F.count("*").alias("n"))
             .where("n > 1").select("band", "low"))
    stars = each.join(least, "band").where("key <> low").select(
        F.col("key").alias("a"), F.col("low").alias("b")).distinct()
    return components(stars).select(F.col("node").alias("key"), F.col("label").alias("part"))


def _blocked(parts: DataFrame) -> DataFrame:
    """(key, part, left, right, own, task) rows: which block pairs verify a class.

    A group of up to BLOCK classes is one block, and small groups share a
    task.  A larger one is cut into blocks by hash; each class goes to the
    pairs of its block with every block of the group, a task each.
    """
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    bins = F.greatest(F.lit(1), F.ceil(F.lit(parts.count()) / BLOCK)).cast("int")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cut = parts.join(sizes, "part").select(
        "key", "part", blocks.alias("blocks"),
        F.pmod(F.xxhash64("key"), blocks).cast("int").alias("own"))
    spread = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    left, right = F.least("own", "other"), F.greatest("own", "other")
    return spread.select(
        "key", "part", left.cast("long").alias("left"), right.cast("long").alias("right"), "own",
        F.when(F.col("blocks") > 1, F.concat_ws(" ", F.hex("part"), left, right))
        .otherwise(F.pmod(F.xxhash64("part"), bins).cast("string")).alias("task"))


def _by_prefix(parts: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """(key, part, left, right, own, task) of large groups: the block pairs that can hold a link.

    Sets of n runs that reach the threshold t share one of their n - ceil(t n) + 1
    rarest runs, in any fixed order of runs; so sets that share none of these
    need not meet.  Classes of one least run hash (a MinHash: linked sets
    mostly share it) form blocks of about BLOCK, and only blocks that hold such a
    shared run are paired.  A class thus travels to as many blocks as hold
    sets like it, however large its group is.
    """
    def unpack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(g, np.int64) for g in batch.column("grams").to_pylist()]
        cut = np.concatenate(([0], np.cumsum([len(g) for g in sets]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("part"),
             pa.array([g[0] for g in sets], pa.int64()),
             pa.ListArray.from_arrays(cut, pa.array(np.concatenate(sets), pa.int64()))],
            names=["key", "part", "least", "grams"])

    sets = saved(map_batches(
        grams.join(parts, "key").dropDuplicates(["key"]).select("key", "part", "grams"), unpack,
        "key binary, part binary, least long, grams array<long>"), "jaccard-large")
    each = sets.select("key", "part", F.explode("grams").alias("gram"))
    often = saved(each.groupBy("part", "gram").agg(F.count("*").alias("n")), "jaccard-often")
    n = F.size("ranked")
    rarest = (each.join(often, ["part", "gram"]).groupBy("key", "part")
              .agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("ranked"))
              .select("key", "part", F.explode(F.slice(
                  "ranked", F.lit(1), n - F.ceil(n * F.lit(threshold) - F.lit(1e-6)).cast("int") + 1))
                  .alias("r"))
              .where("r.n > 1").select("key", "part", F.col("r.gram").alias("gram")))
    cuts = sets.groupBy("part", "least").agg(F.ceil(F.count("*") / BLOCK).alias("cuts"))
    blocks = saved(sets.select("key", "part", "least").join(cuts, ["part", "least"]).select(
        "key", "part", F.xxhash64("least", F.pmod(F.xxhash64("key"), F.col("cuts"))).alias("block")),
        "jaccard-blocks")
    held = saved(rarest.join(blocks, ["key", "part"]).select("part", "gram", "block").distinct(),
                 "jaccard-held")
    other = held.select("part", "gram", F.col("block").alias("right"))
    pairs = saved(
        held.withColumnRenamed("block", "left").join(other, ["part", "gram"]).where("left < right")
        .select("part", "left", "right").distinct()
        .unionAll(blocks.select("part", F.col("block").alias("left"), F.col("block").alias("right"))
                  .distinct()), "jaccard-pairs")
    sides = F.array_distinct(F.array(F.struct(F.col("left").alias("block"), F.lit(0).alias("own")),
                                     F.struct(F.col("right").alias("block"),
                                              (F.col("left") != F.col("right")).cast("int").alias("own"))))
    sent = saved(pairs.select("part", "left", "right", F.explode(sides).alias("side"))
                 .select("part", "left", "right", "side.block", "side.own")
                 .join(blocks, ["part", "block"]), "jaccard-sent")
    bins = max(1, -(-sent.count() // (2 * BLOCK)))
    return sent.select("key", "part", "left", "right", "own", F.concat(F.lit("pair "), F.pmod(
        F.xxhash64("part", "left", "right"), F.lit(bins)).cast("string")).alias("task"))


def _sent(parts: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """Which tasks every class goes to: by all blocks of its group, or by shared rare runs.

    Meeting all blocks sends a class as often as its group has blocks.  In groups
    of more than MANY blocks the rare runs are looked up first; such a group
    takes whichever sends fewer rows.  Either finds every link.
    """
    sizes = saved(parts.groupBy(F.col("part").alias("large")).agg(F.count("*").alias("size"))
                  .where(F.col("size") > MANY * BLOCK), "jaccard-sizes")
    if sizes.isEmpty():
        return _blocked(parts)
    rare = _by_prefix(parts.join(sizes, parts["part"] == sizes["large"], "left_semi"), grams,
                      threshold)
    fewer = saved(rare.groupBy(F.col("part").alias("fewer")).agg(F.count("*").alias("n"))
                  .join(sizes, F.col("fewer") == F.col("large"))
                  .where(F.col("n") < F.col("size") * F.ceil(F.col("size") / BLOCK))
                  .select("fewer"), "jaccard-fewer")
    rest = parts.join(fewer, parts["part"] == fewer["fewer"], "left_anti")
    return _blocked(rest).unionByName(
        rare.join(fewer, rare["part"] == fewer["fewer"], "left_semi"))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted distinct hashes."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    rows = np.repeat(np.arange(len(left)), [len(x) for x in left])
    columns = np.repeat(np.arange(len(right)), [len(x) for x in right])
    if not len(shared):
        return out
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    at_a[at_a == len(shared)] = at_b[at_b == len(shared)] = 0
    in_a, in_b = shared[at_a] == a, shared[at_b] == b
    rows, at_a, columns, at_b = rows[in_a], at_a[in_a], columns[in_b], at_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    rows, at_a, columns, at_b = rows[order_a], at_a[order_a], columns[order_b], at_b[order_b]
    step = max(64, (4 << 20) // (4 * (len(left) + len(right))))    # bounded memory
    for lo in range(0, len(shared), step):
        hi = min(lo + step, len(shared))
        p, q = np.zeros((len(left), hi - lo), np.float32), np.zeros((len(right), hi - lo), np.float32)
        i, j = np.searchsorted(at_a, [lo, hi]), np.searchsorted(at_b, [lo, hi])
        p[rows[i[0]:i[1]], at_a[i[0]:i[1]] - lo] = 1
        q[columns[j[0]:j[1]], at_b[j[0]:j[1]] - lo] = 1
        out += p @ q.T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of two lists reach the Jaccard threshold."""
    common = common_counts(left, right).astype(np.float64)
    sizes = (np.array([len(x) for x in left], np.float64)[:, None]
             + np.array([len(x) for x in right], np.float64))
    return common >= threshold * (sizes - common) - 1e-6


def _forest(links: np.ndarray) -> np.ndarray:
    """The least index reached from each one over a symmetric link matrix."""
    root = np.full(len(links), -1)
    for i in range(len(links)):
        if root[i] >= 0:
            continue
        front = np.zeros(len(links), dtype=bool)
        front[i] = True
        seen = front.copy()
        while front.any():
            reach = links[front].any(axis=0) & ~seen
            seen |= reach
            front = reach
        root[seen] = i
    return root


def _verify_group(keys: list[bytes], own: np.ndarray, copies: np.ndarray,
                  sets: list[np.ndarray], cross: bool, threshold: float
                  ) -> tuple[list[bytes], list[bytes], list[int]]:
    """(key, root key, linked documents) of one block, or of a pair of blocks."""
    order = sorted(range(len(keys)), key=lambda i: (own[i], keys[i]))
    keys, sets = [keys[i] for i in order], [sets[i] for i in order]
    own, copies = own[order], copies[order]
    n = len(keys)
    links = np.zeros((n, n), dtype=bool)
    if cross:
        middle = int(np.searchsorted(own, own[-1])) if own[0] != own[-1] else n
        if middle < n:
            found = linked(sets[:middle], sets[middle:], threshold)
            links[:middle, middle:], links[middle:, :middle] = found, found.T
    else:
        links = linked(sets, sets, threshold)
        np.fill_diagonal(links, False)
    root = _forest(links)
    return keys, [keys[r] for r in root], (links @ copies).astype(int).tolist()


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """(key, root, links) rows of all block pairs."""
    ship(members.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        part, left, right, own, copies = (group[c].to_pylist()
                                          for c in ("part", "left", "right", "own", "copies"))
        keys, grams = group["key"].to_pylist(), group["grams"].to_pylist()
        by_part: dict[tuple, dict[bytes, int]] = {}
        for i, p in enumerate(zip(part, left, right, strict=True)):
            by_part.setdefault(p, {})[keys[i]] = i        # a repeated row counts once
        out: tuple[list, list, list] = ([], [], [])
        for rows in by_part.values():
            at = list(rows.values())
            found = _verify_group(
                [keys[i] for i in at], np.array([own[i] for i in at]),
                np.array([copies[i] for i in at], np.int64),
                [np.frombuffer(grams[i], np.uint64) for i in at],
                left[at[0]] != right[at[0]], threshold)
            for target, values in zip(out, found, strict=True):
                target.extend(values)
        return pa.table([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()),
                         pa.array(out[2], pa.int64())], names=["key", "root", "links"])

    return members.groupBy("task").applyInArrow(
        run, "key binary, root binary, links long")


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         words: int = WORDS, threshold: float = THRESHOLD, recall: float = 0.9999) -> DataFrame:
    """(id, class_id, n_links) of every row: near-duplicate classes over whole texts.

    Two texts are linked if the Jaccard similarity of their sets of runs of
    ``words`` words (a shorter text has one run) reaches ``threshold``.
    ``n_links`` counts the other rows linked to this one, copies included;
    ``class_id`` is the least id of all rows reached over links.  Null and
    empty texts, and others without words, are copies of each other.
    Repeated rows are copies; rows of null id are kept (a class of such rows
    only has a null class id); other columns are ignored; an empty table
    gives an empty one.
    """
    signed, named = _named(docs, id_col, text_col, words, threshold, recall)
    ids = named.groupBy("label").agg(F.min("first").alias("class_id"))
    return signed.select("id", "key").join(named.join(ids, "label"), "key").select(
        F.col("id").alias(id_col), "class_id", "n_links")


def _named(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: float,
           recall: float) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (key, first, row, label, n_links) of every class of copies.

    ``row`` is the class's least row: those with an id first, then by id and text hash.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = saved(_signed(docs, id_col, text_col, words, bands, rows), "jaccard-signed")
    classes = saved(signed.groupBy("key").agg(
        F.min("id").alias("first"),
        F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "text_hash")).alias("row"),
        F.count("*").alias("copies"),
        F.first("bands").alias("bands")), "jaccard-classes")
    parts = saved(_candidates(classes), "jaccard-parts")
    wanted = parts.join(classes.select("key", "first", "copies"), "key")
    # a class's text is read again by the id of its first row; rows of null id always are
    texts = (docs.where(F.col(id_col).isNotNull())
             .join(wanted.select(F.col("first").alias(id_col)).distinct(), id_col, "left_semi")
             .unionByName(docs.where(F.col(id_col).isNull())).select(F.col(text_col).alias("text")))

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [(key, grams.tobytes()) for _, grams, key in gram_sets(batch.column(0), words)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.binary()),
             pa.array([g for _, g in found], pa.binary())], names=["key", "grams"])

    grams = map_batches(texts, sets, "key binary, grams binary")
    sent = _sent(parts, grams, threshold)
    members = grams.join(sent, "key").join(classes.select("key", "copies"), "key")
    verified = saved(_verified(members, threshold), "jaccard-verified")
    reached = components(verified.where("key <> root").select(
        F.col("key").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    named = (classes.select("key", "first", "row", "copies")
             .join(reached.select(F.col("node").alias("key"), "label"), "key", "left")
             .join(links, "key", "left")
             .select("key", "first", "row", F.coalesce("label", "key").alias("label"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return signed, named


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                words: int = WORDS, threshold: float = THRESHOLD, recall: float = 0.9999
                ) -> DataFrame:
    """The row of least id of every near-duplicate class, with all its columns.

    A row is known by its id and its text's hash: of rows that repeat both one
    stays, and of texts under the class's least id the one of least hash.  A
    row of null id stays only if its class has no row with an id.
    """
    _, named = _named(docs, id_col, text_col, words, threshold, recall)
    own, its, hashed = fresh(docs, "first_id", "first_hash", "text_hash")
    first = named.groupBy("label").agg(F.min("row").alias("row")).select(
        F.col("row.id").alias(own), F.col("row.text_hash").alias(its))
    rows = docs.withColumn(hashed, F.xxhash64(text_col))
    return (rows.join(first, F.col(id_col).eqNullSafe(F.col(own)) & (F.col(hashed) == F.col(its)),
                      "left_semi")
            .dropDuplicates([id_col, hashed]).drop(hashed))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: near-duplicate class and links of every document."""
    return join(table(spark, sf_dir, "documents"))
