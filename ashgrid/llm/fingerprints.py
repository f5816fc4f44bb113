"""Document fingerprints by one-permutation MinHash, in Spark functions alone.

The shingles (runs of five words) of a text are hashed once.  The top bits of
a hash name its bin, and each bin keeps its least hash.  To get every bin's
minimum in order without scattering, one sentinel per bin, its largest value,
joins the hashes before they are sorted: the first value of each bin is then
its minimum, or its sentinel if it is empty.  An empty bin draws bins by its own
hash sequence, alike for all texts, until it meets a filled one, and takes
that one's value (optimal densification).  Of every bin's value, hashed with
the bin, the low four bits are kept, one hexadecimal digit per bin.  Two fingerprints that agree in the share m of
their bins are alike to (m - 1/16) / (1 - 1/16), as a sixteenth of unequal
bins agrees by chance.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import kind, table

BINS_LOG2 = 8
BINS = 1 << BINS_LOG2
WORDS = 5
#: Independent draws of an empty bin, tried one by one and then together; after
#: them (a text of very few shingles) it takes the next filled bin.
DRAWS, MORE_DRAWS = 10, 64
#: Value bits of a hash below its bin.
_SHIFT = 63 - BINS_LOG2
_LOW = (1 << _SHIFT) - 1

#: Words are maximal runs of letters and digits of the lower-cased text.
_BETWEEN = r"[^\p{L}\p{N}]+"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), use)[0]


def _numbers(values: list[int], kind: str) -> Column:
    """A constant array, written as one literal (a literal per number makes huge plans)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def words(text: Column) -> Column:
    """The lower-cased words of a text (null: none)."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), lambda w: w != "")


def shingle_hashes(text: Column) -> Column:
    """63-bit hashes of all runs of five words; shorter texts have one run of what they have."""
    def runs(h: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.size(h) - WORDS),
            lambda i: F.xxhash64(*(h[i + k] for k in range(WORDS))).bitwiseAND(F.lit((1 << 63) - 1)))
        one = F.array(F.xxhash64(h).bitwiseAND(F.lit((1 << 63) - 1)))
        return F.when(F.size(h) >= WORDS, several).otherwise(one)

    return _let(F.transform(words(text), lambda w: F.xxhash64(w)), runs)


def bin_minima(hashes: Column) -> Column:
    """The least hash of each bin in order, a bin's largest value if it is empty."""
    sentinels = _numbers([(b << _SHIFT) | _LOW for b in range(BINS)], "bigint")

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (
            F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT)))

    return _let(F.sort_array(F.concat(hashes, sentinels)), firsts)


def densified(minima: Column) -> Column:
    """Four bits of every bin's minimum; empty bins draw among the filled ones.

    The bits are those of a hash of value and bin: bins that share a value
    (as in a text of few words) would else agree or differ all at once.
    """
    draws = [random.Random(b) for b in range(BINS)]
    first = [_numbers([r.randrange(BINS) for r in draws], "int") for _ in range(DRAWS)]
    more = _numbers([r.randrange(BINS) for r in draws for _ in range(MORE_DRAWS)], "int")
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))

    def earliest(v: Column, places: Column) -> Column:
        """The value of the first of the places that is filled, if any is."""
        return F.get(F.filter(F.transform(places, lambda j: F.get(v, j)),
                              lambda x: x.isNotNull()), F.lit(0))

    def dense(v: Column) -> Column:
        return F.transform(bins, lambda b: F.xxhash64(F.coalesce(
            F.get(v, b), *(F.get(v, F.get(d, b)) for d in first),
            earliest(v, F.slice(more, b * MORE_DRAWS + 1, MORE_DRAWS)),
            earliest(v, F.transform(bins, lambda t: (b + t) % BINS))), b
        ).bitwiseAND(F.lit(15)))

    filled = F.transform(minima, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != _LOW, x))
    return _let(filled, dense)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as 256 hexadecimal digits.

    Texts without words (null, empty, signs only) share the fingerprint of
    one empty run.
    """
    digit = F.transform(densified(bin_minima(shingle_hashes(text))),
                        lambda x: F.substr(F.lit("0123456789abcdef"), x.cast("int") + 1, F.lit(1)))
    return F.array_join(digit, "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1, corrected for chance."""
    same = F.size(F.filter(F.arrays_zip(F.split(a, "").alias("a"), F.split(b, "").alias("b")),
                           lambda p: p["a"] == p["b"]))
    share = same / F.lit(float(BINS))
    return F.when(a == b, 1.0).otherwise(
        F.greatest(F.lit(0.0), (share - 1 / 16) / (1 - 1 / 16)))


def _cuts_up_to(key: Column, cuts: list) -> Column:
    """How many of the sorted cuts are at most ``key``: first by every n-th cut, then within."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts) - 1) + 1

    def constant(values: list) -> Column:
        if all(isinstance(v, int) for v in values):
            return _numbers(values, "bigint")
        return F.array(*(F.lit(v) for v in values))

    def up_to(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= key))

    return _let(up_to(constant(cuts[::step])), lambda n: F.when(n == 0, 0).otherwise(
        (n - 1) * step + up_to(F.slice(constant(cuts), (n - 1) * step + 1, step))))


def _cuts(df: DataFrame, key: str, parts: int) -> list:
    """Up to ``parts - 1`` keys that cut the rows into ranges; only balance depends on them.

    Approximate quantiles of numbers and times; of texts, which Spark has none
    of, evenly spaced ones of 16 different keys a range, chosen by hash.
    """
    if kind(df, key) not in ("string", "binary"):
        return sorted(set(df.agg(F.percentile_approx(
            key, [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []))
    some = (df.where(F.col(key).isNotNull()).select(key).distinct()
            .orderBy(F.xxhash64(key)).limit(16 * parts).collect())
    return sorted(r[0] for r in some)[16::16]      # by code point, as Spark sorts UTF-8


def with_next(df: DataFrame, key: str, value: str, names: dict[str, str], *,
              prepare: Callable[[DataFrame], DataFrame] = lambda d: d,
              parts: int | None = None) -> DataFrame:
    """Every row with columns of the row that follows by ascending ``key`` (last: the first).

    ``df`` has the columns ``key`` (a number, a time or a text) and ``value``;
    ``prepare`` may add more, row by row.  ``names`` says which columns of the
    following row to add, and as what.  The keys are cut into ``parts`` ranges
    (default: six a shuffle partition, so that partitions even out); each range is sorted in its own
    task and gets a copy of the following range's first row, so no task holds
    the whole order, and rows are exchanged once.  Rows of a null key come
    first; equal keys are taken in the order of ``value``.
    """
    spark = df.sparkSession
    parts = parts or 6 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(df, key, parts)
    ranged = df.withColumn("__range", F.when(F.col(key).isNull(), 0).otherwise(
        _cuts_up_to(F.col(key), cuts)))
    stats = (ranged.groupBy("__range")                        # at most ``parts`` rows
             .agg(F.min(key).alias("__least"), F.max(F.col(key).isNull()).alias("__null"))
             .orderBy("__range").collect())
    if not stats:
        return prepare(df).select("*", *(F.col(c).alias(n) for c, n in names.items()))
    # the first row of a range goes to the one before it; the very first to the last
    goes = spark.createDataFrame(
        [(r["__range"], None if r["__null"] else r["__least"], stats[i - 1]["__range"])
         for i, r in enumerate(stats)],
        f"__range int, __least {kind(df, key)}, __before int")
    heads = (ranged.join(F.broadcast(goes), "__range")
             .where(F.col(key).eqNullSafe(F.col("__least"))))
    guards = (heads.groupBy("__before").agg(F.min(value).alias(value), F.first(key).alias(key))
              .select(key, value, F.col("__before").alias("__range"), F.lit(True).alias("__guard")))
    rows = prepare(ranged.select(key, value, "__range", F.lit(False).alias("__guard"))
                   .unionByName(guards))
    window = Window.partitionBy("__range").orderBy(
        "__guard", F.col(key).asc_nulls_first(), F.col(value).asc_nulls_first())
    return (rows.select("*", *(F.lead(c).over(window).alias(n) for c, n in names.items()))
            .where(~F.col("__guard")).drop("__guard", "__range"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by the start of the following one."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - quarter),
                    F.substr(following, F.lit(1), quarter))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Over whole texts; a null text is an empty one.  Rows of equal ids follow
    each other by text; repeated rows stay repeated; a table of one row
    follows itself; an empty table gives an empty one; other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).alias("__id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    paired = with_next(rows, "__id", "__text", {"__text": "__next", "__mark": "__next_mark"},
                       prepare=lambda d: d.withColumn("__mark", fingerprint(F.col("__text"))))
    changed = paired.select("__id", "__mark", "__next_mark",
                            F.char_length("__text").cast("long").alias("n_chars"),
                            edited(F.col("__text"), F.col("__next")).alias("__edited"))
    marked = changed.select("*", fingerprint(F.col("__edited")).alias("edited_fingerprint"))
    return marked.select(
        F.col("__id").alias(id_col), "n_chars", F.sha2("__edited", 256).alias("edited_sha256"),
        F.col("__mark").alias("fingerprint"), "edited_fingerprint",
        likeness(F.col("__mark"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("__mark"), F.col("__next_mark")).alias("near_next"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
