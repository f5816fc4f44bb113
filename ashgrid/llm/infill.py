"""Fill-in-the-middle: texts rearranged by sorting their pieces, and put back by sorting again.

A text's lines are cut at two places drawn from a hash of its id into prefix,
middle and suffix.  Its pieces (runs of lines of a bounded size; a longer line
is cut) are dealt out by document and sorted by their position in the output,
so every task streams whole documents, piece by piece: the output's digest
grows with each, and no document is ever held as a whole.  The same stream is
read as its marks say: what follows ``<P>``, ``<S>`` and ``<M>`` gets its
place in the original, the pieces are sorted again, without another exchange,
and a second stream rebuilds the text.

This is Spark's repartition-and-sort-within-partitions, in its DataFrame form,
which sorts and spills inside the JVM.  A document's key is its content and
the input partition it came from: equal rows of a partition travel once, with
their number, and a row repeated all over the table spreads over the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import kind, ship, table
from .texts import slices

#: The marks, and the section that each opens: 0 prefix, 1 middle, 2 suffix.
MARKS = {b"<P>": 0, b"<M>": 1, b"<S>": 2}
#: The marks of a form in the order they are written.
ORDER = {"psm": (b"<P>", b"<S>", b"<M>"), "spm": (b"<S>", b"<P>", b"<M>")}
#: Bytes of a piece.
PIECE = 1 << 15
_KEY = ("k1", "k2", "origin")
_DEALT = "k1 long, k2 long, origin int"


def cuts(data: bytes, h1: int, h2: int) -> tuple[int, int, int]:
    """(number of lines, end of the prefix, end of the middle) of a text, ends in bytes."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if data and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    n = len(ends)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, int(ends[a - 1]) if a else 0, int(ends[b - 1]) if b else 0


def chunks(data: bytes, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``data[lo:hi]`` of at most PIECE bytes that end with a line where one does."""
    while lo < hi:
        end = min(hi, lo + PIECE)
        if end < hi:
            end = data.rfind(b"\n", lo, end) + 1 or end
        yield lo, end
        lo = end


def _chars(data: bytes) -> int:
    """Code points: bytes that don't continue one."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def _batched(make: Callable, schema: pa.Schema) -> Callable:
    """A map over all batches of a partition: rows of ``make``, in batches of bounded bytes."""
    weigh = [i for i, f in enumerate(schema) if pa.types.is_binary(f.type)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in make(batches):
            held.append(row)
            size += 64 + sum(len(row[i] or b"") for i in weigh)
            if size >= 4 << 20:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)
    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema)


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _arrow(docs: DataFrame, id_col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(docs.schema[id_col].dataType)


def pieces(docs: DataFrame, *, rate: int = 100, spm: int = 50, seed: int = 7,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every text's output: (key, position, copies, id, n, form, prefix_chars,
    middle_chars, piece), dealt out by document and sorted by position.

    Four numbers are drawn per row from the hex sha256 of ``seed:id``; two cut
    the text, ``rate`` percent of texts are rearranged, ``spm`` percent of
    those with the suffix first.  Empty and null texts, and texts that hold a
    mark, stay plain; they have one piece at least.  A null id draws as an
    empty one.  Equal rows are one document of several copies.
    """
    ship(docs.sparkSession)
    ident = _arrow(docs, id_col)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"),
                                                          F.lit(""))), 256)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.xxhash64(F.col(id_col).cast("string"), text).alias("k1"),
        F.xxhash64(text, F.lit(seed)).alias("k2"), F.spark_partition_id().alias("origin"),
        *(F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
          for i in range(4)),
        F.col(id_col).alias("id"), text.alias("text"))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("origin", pa.int32()),
                        ("position", pa.int64()), ("copies", pa.int64()), ("id", ident),
                        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("piece", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            k1, k2, origin, h1, h2, h3, h4, ids = (c.to_pylist() for c in batch.columns[:8])
            copies: dict[tuple[int, int], int] = {}
            for key in zip(k1, k2, strict=True):
                copies[key] = copies.get(key, 0) + 1
            for lo, _, texts in slices(batch.column(8)):
                for i, t in enumerate(texts, lo):
                    number = copies.pop((k1[i], k2[i]), 0)
                    if not number:                 # a repeated row of this batch
                        continue
                    data = t.encode()
                    n, a, b = cuts(data, h1[i], h2[i])
                    key = (k1[i], k2[i], origin[i])
                    if not data or h3[i] % 100 >= rate or any(m in data for m in MARKS):
                        head = (number, ids[i], n, "plain", None, None)
                        for at, (x, y) in enumerate(chunks(data, 0, len(data))):
                            yield *key, at, *head, data[x:y]
                        if not data:
                            yield *key, 0, *head, b""
                        continue
                    form = "spm" if h4[i] % 100 < spm else "psm"
                    head = (number, ids[i], n, form, _chars(data[:a]), _chars(data[a:b]))
                    section = ((0, a), (a, b), (b, len(data)))
                    # pieces leave in the text's order and are sorted into the output's
                    for mark, place in sorted(MARKS.items(), key=lambda m: m[1]):
                        at = ORDER[form].index(mark) << 40
                        yield *key, at, *head, mark
                        for x, y in chunks(data, *section[place]):
                            at += 1
                            yield *key, at, *head, data[x:y]

    made = rows.mapInArrow(
        _batched(make, schema),
        f"{_DEALT}, position long, copies long, id {kind(docs, id_col)}, n long, form string, "
        "prefix_chars long, middle_chars long, piece binary")
    return made.repartition(*_KEY).sortWithinPartitions(*_KEY, "position")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple, Iterator[bytes]]]:
    """(key, first row, its pieces in order) of every document of a sorted partition.

    Equal rows of different batches of one origin repeat their positions: each
    counts once; their copies are summed in the first row after the pieces
    have been read (a list, as it is filled meanwhile).
    """
    for key, rows in groupby(_sorted_rows(batches), key=lambda r: r[:3]):
        first = next(rows)
        copies = [first[4]]

        def stream(first=first, rows=rows, copies=copies):
            at = first[3]
            yield first[10]
            for row in rows:
                if row[3] != at:
                    at = row[3]
                    yield row[10]
                elif at == first[3]:
                    copies[0] += row[4]
        yield key, (copies, *first[5:10]), stream()


def sections(form: str, stream: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """(section, bytes) of an output as it streams by, read by its marks alone.

    Sections of a rearranged text hold no mark, so the next mark expected is
    found where it was written, also where it straddles two pieces.
    """
    if form == "plain":
        for piece in stream:
            yield 0, piece
        return
    todo = list(ORDER[form])
    now, rest = -1, b""
    for piece in stream:
        rest += piece
        while todo and (at := rest.find(todo[0])) >= 0:
            if at:
                yield now, rest[:at]
            now, rest = MARKS[todo[0]], rest[at + 3:]
            todo.pop(0)
        keep = 2 if todo else 0                    # a mark may have begun
        if len(rest) > keep:
            yield now, rest[:len(rest) - keep]
            rest = rest[len(rest) - keep:]
    if rest:
        yield now, rest


def outputs(docs: DataFrame, **options: object) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row: the rearranged texts.

    Options are those of ``pieces``.  Repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty one.
    """
    id_col = str(options.get("id_col", "doc_id"))
    schema = pa.schema([(id_col, _arrow(docs, id_col)), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("output", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, (copies, *head), stream in _documents(batches):
            output = b"".join(stream)
            for _ in range(copies[0]):
                yield *head, output

    made = pieces(docs, **options).mapInArrow(
        _batched(make, schema), f"`{id_col}` {kind(docs, id_col)}, n long, form string, "
        "prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.decode("output", "utf-8"))


def digests(docs: DataFrame, **options: object) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row.

    ``restored_sha256`` is of the text rebuilt from the output and its form.
    Options are those of ``pieces``.  Repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty one.
    """
    id_col = str(options.get("id_col", "doc_id"))
    own = kind(docs, id_col)
    key = [("k1", pa.int64()), ("k2", pa.int64()), ("origin", pa.int32())]
    facts = [("id", _arrow(docs, id_col)), ("n", pa.int64()), ("form", pa.string()),
             ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
    cut = pa.schema([*key, ("section", pa.int32()), ("place", pa.int64()), ("copies", pa.int64()),
                     *facts, ("output_sha256", pa.string()), ("piece", pa.binary())])
    out = pa.schema([(id_col, facts[0][1]), *facts[1:], ("output_sha256", pa.string()),
                     ("restored_sha256", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        none = (None,) * 7
        for key, (copies, *head), stream in _documents(batches):
            digest = hashlib.sha256()

            def seen(stream=stream, digest=digest):
                for piece in stream:
                    digest.update(piece)
                    yield piece
            for place, (section, data) in enumerate(sections(head[2], seen())):
                yield *key, section, place, *none, data
            # the document's own row sorts before its pieces
            yield *key, -1, -1, copies[0], *head, digest.hexdigest(), None

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, rows in groupby(_sorted_rows(batches), key=lambda r: r[:3]):
            _, _, _, _, _, copies, *head, output, _ = next(rows)
            digest = hashlib.sha256()
            for row in rows:
                digest.update(row[12])
            for _ in range(copies):
                yield *head, output, digest.hexdigest()

    back = pieces(docs, **options).mapInArrow(
        _batched(read, cut), f"{_DEALT}, section int, place long, copies long, id {own}, n long, "
        "form string, prefix_chars long, middle_chars long, output_sha256 string, piece binary"
    ).sortWithinPartitions(*_KEY, "section", "place")
    return back.mapInArrow(
        _batched(rebuild, out), f"`{id_col}` {own}, n long, form string, prefix_chars long, "
        "middle_chars long, output_sha256 string, restored_sha256 string")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all documents rearranged and restored, with digests of both."""
    return digests(table(spark, sf_dir, "documents"))
