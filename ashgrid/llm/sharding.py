"""Sharding by histogram sort: equal bytes per shard, one exchange.

Every row has a 64-bit key: the high 40 bits come from a hash of its text, so
equal texts are neighbours, the low 24 from a hash of its id, so that even a
third of all rows with one text can be cut.  Rows that share their key (they
repeat id and text, or have no id) get these bits from their place in a
written table instead.  Splitters are found without
sorting: the exact bytes below evenly spaced probe keys are counted over all
partitions, the probes that enclose each target become its new bracket, and
the bracket is probed again until a probe is within tolerance of its target.
Then every row knows its range and rows are exchanged once; sorting each
range by key gives the slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import kind, map_batches, saved, ship, table

#: Probe keys of one counting pass, over all splitters.
PROBES = 4096
_ID_BITS = 24
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def keyed(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, __size, __crc, __key) of every row; a null text is an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = (1 << _ID_BITS) - 1
    return docs.select(
        F.col(id_col).alias("__id"), *(F.col(c).alias(f"__keep_{c}") for c in keep),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("__size"),
        F.crc32(text.cast("binary")).alias("__crc"),
        F.xxhash64(text).bitwiseAND(F.lit(~low)).bitwiseOR(
            F.xxhash64(F.col(id_col).cast("string")).bitwiseAND(F.lit(low))).alias("__key"))


def cuttable(light: DataFrame, docs: DataFrame, id_col: str, text_col: str,
             keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(rows without, rows with the kept columns), keyed so that repeated rows differ too.

    Rows that share a key are told apart by file and position in a written
    table, so a task that runs again sees the same keys; which of several
    equal rows gets which key makes no difference.
    """
    again = light.groupBy("__key").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return light, keyed(docs, id_col, text_col, keep) if keep else light
    rows = saved(keyed(docs, id_col, text_col, keep), "shard-rows") if keep else light
    again = again.select(F.col("__key").alias("__again"))
    low = F.lit((1 << _ID_BITS) - 1)
    placed = rows.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("__at"))
    own = F.col("__key").bitwiseAND(F.lit(~((1 << _ID_BITS) - 1))).bitwiseOR(F.col("__at").bitwiseAND(low))
    placed = placed.join(again, F.col("__key") == F.col("__again"), "left")
    rows = saved(placed.withColumn("__key", F.when(F.col("__again").isNotNull(), own)
                                   .otherwise(F.col("__key"))).select(rows.columns), "shard-rows")
    return rows, rows


def histogram(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (bytes, rows) between neighbouring probe keys: below the first, ..., from the last."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(probes)   # at most PROBES keys

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        size = np.zeros(len(cuts) + 1, np.int64)
        number = np.zeros(len(cuts) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(cuts, batch.column("__key").to_numpy(), "right")
            np.add.at(size, at, batch.column("__size").to_numpy())
            number += np.bincount(at, minlength=len(cuts) + 1)
        some = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]),
                                          pa.array(number[some])],
                                         names=["place", "size", "number"])

    got = (rows.select("__key", "__size").mapInArrow(count, "place long, size long, number long")
           .groupBy("place").agg(F.sum("size"), F.sum("number")).collect())
    size, number = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for place, s, n in got:                                    # at most PROBES + 1 rows
        size[place], number[place] = s, n
    return size, number


def _spread(low: int, high: int, n: int) -> list[int]:
    """Up to ``n`` different keys strictly between two keys, evenly spaced."""
    n = min(n, high - low - 1)
    return [low + (high - low) * i // (n + 1) for i in range(1, n + 1)]


def splitters(rows: DataFrame, total: int, ranges: int, tolerance: int) -> np.ndarray:
    """Keys that cut the rows into ``ranges`` ranges of near-equal bytes.

    Each of the ``ranges - 1`` keys has within ``tolerance`` bytes of its share
    below it, or no key is closer to it.
    """
    targets = [total * i // ranges for i in range(1, ranges)]
    low, high = [_LOWEST] * len(targets), [_HIGHEST] * len(targets)
    best: list[tuple[int, int]] = [(total, _LOWEST)] * len(targets)    # (distance, key)
    while True:
        todo = [i for i in range(len(targets))
                if best[i][0] > tolerance and high[i] - low[i] > 1]
        if not todo:
            return np.array([key for _, key in best], np.int64)
        each = max(1, PROBES // len(todo))
        probes = np.array(sorted({k for i in todo for k in _spread(low[i], high[i], each)}),
                          np.int64)
        below = np.cumsum(histogram(rows, probes)[0])[:-1]     # bytes of keys < each probe
        for i in todo:
            after = int(np.searchsorted(below, targets[i], "left"))   # first probe that reaches it
            for at in (after - 1, after):
                if 0 <= at < len(probes):
                    best[i] = min(best[i], (abs(int(below[at]) - targets[i]), int(probes[at])))
            if after < len(probes):
                high[i] = min(high[i], int(probes[after]))
            if after:
                low[i] = max(low[i], int(probes[after - 1]))


def shard(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = (), tolerance: float = 0.001,
          range_rows: int = 1_000_000) -> DataFrame:
    """(id, kept columns, size, text_crc32, shard, slot): near-equal bytes in every shard.

    Size is the text's UTF-8 bytes plus one.  ``tolerance`` is the share of a
    shard's bytes by which a cut may miss its place; a row larger than that
    can miss by its own size.  Every shard is sorted in ranges of about
    ``range_rows`` rows, each its own task, so shards may be of any size.
    Null texts count as empty, null ids as any other id, repeated rows get a
    slot each and are cut like others; an empty table gives an empty one.
    """
    light, rows = cuttable(saved(keyed(docs, id_col, text_col), "shard-keys"), docs, id_col,
                           text_col, keep)
    count, total = light.agg(F.count("*"), F.coalesce(F.sum("__size"), F.lit(0))).first()
    parts = max(1, -(-count // (shards * range_rows)))
    cuts = np.sort(splitters(light, total, shards * parts, int(tolerance * total / shards))
                   ) if count else np.zeros(shards * parts - 1, np.int64)
    # every range's first slot: the rows of its shard's earlier ranges
    number = histogram(light, cuts)[1].reshape(shards, parts)
    slots = (np.cumsum(number, axis=1) - number).ravel()
    shared = docs.sparkSession.sparkContext.broadcast((cuts, slots))   # 16 bytes per range
    names = rows.columns
    schema = ", ".join(f"`{c}` {kind(rows, c)}" for c in names)

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, first = shared.value
        at = np.searchsorted(keys, batch.column("__key").to_numpy(), "right")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(at.astype(np.int32)), pa.array(first[at])],
            names=[*names, "__range", "__first"])

    placed = map_batches(rows, place, f"{schema}, __range int, __first long")
    window = Window.partitionBy("__range").orderBy("__key", "__id", "__size", "__crc")
    return placed.select(
        F.col("__id").alias(id_col), *(F.col(f"__keep_{c}").alias(c) for c in keep),
        F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.floor(F.col("__range") / parts).cast("int").alias("shard"),
        (F.col("__first") + F.row_number().over(window) - 1).alias("slot"))


def write_shards(docs: DataFrame, shards: int, path: str, **options: object) -> None:
    """Write whole rows as parquet, one folder per shard, each in slot order.

    Columns named ``size``, ``text_crc32``, ``shard`` or ``slot`` are replaced.
    """
    own = {"size", "text_crc32", "shard", "slot", str(options.get("id_col", "doc_id"))}
    kept = tuple(c for c in docs.columns if c not in own)
    shard(docs, shards, keep=kept, **options).write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all documents in 16 shards of near-equal bytes."""
    return shard(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
