"""Filter interaction audit: what every order of a set of filters removes.

Filters look at one row each, but for one: a text is a duplicate if a row of
a smaller id holds the same text.  That one is an existential self-join: a
left-semi join on the text's hash, the exact text and a smaller id.  Its ids
are united with the failures of the other filters, and rows are counted once
per part and combination of failures.  Every figure of every order follows
from those counts: a step removes the combinations that hold its filter and
none before it.

Only rows whose hash occurs under two ids go into the self-join, and its
right side is one row per text (the least id answers for all smaller ones),
so no pairs within a group of copies are made.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import saved, table

#: Word limits, shares and signs of the registered query's filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 2, r"[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_filters(text_col: str = "text") -> dict[str, Column]:
    """Failure conditions A to D: short, repetitive, loud, or with signs; a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {"A": F.size(words) < LEAST_WORDS,
            "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
            "C": capitals * 100 > F.length(text) * MOST_CAPITALS,
            "D": F.rlike(text, F.lit(SIGNS))}


def duplicates(rows: DataFrame) -> DataFrame:
    """Rows (id, text, hash, ...) whose text a row of a smaller id holds too.

    Null ids are smaller than none and larger than none.
    """
    # written first: an aggregate in the join's own stage would keep Spark from
    # splitting the hash of a large group of copies
    repeated = saved(rows.groupBy("hash").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                     .where("lo < hi").select("hash"), "audit-hashes")
    some = saved(rows.join(repeated, "hash", "left_semi"), "audit-repeated")
    first = saved(some.groupBy("hash", "text").agg(F.min("id").alias("first_id")), "audit-first")
    return some.join(first, (some["hash"] == first["hash"]) & (some["text"] == first["text"])
                     & (first["first_id"] < some["id"]), "left_semi")


def combinations(docs: DataFrame, filters: dict[str, Column], duplicate: str, *,
                 marks: dict[str, Column] | None = None, labels: DataFrame | None = None,
                 id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """(part, failed, n, one count per mark) of every combination of failures that occurs.

    ``filters`` are conditions over a row; ``duplicate`` names the filter for
    repeated texts.  ``failed`` has one bit per filter, the first lowest.
    ``marks`` are conditions over ``labels``; a document has a mark if any
    label row of its id has.  A condition that is null counts as not met.
    Null texts and parts count as empty; repeated rows count each; null ids
    neither are nor have duplicates, and no label; other columns are ignored,
    whatever their names; an empty table gives an empty one.
    """
    letters = [*filters, duplicate]
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.xxhash64(text).alias("hash"))
    light = docs.select(F.col(id_col).alias("id"),
                        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.xxhash64(text).alias("hash"), bits.alias("bits"), F.lit(1).alias("n"))
    again = duplicates(rows).select("id", "part", "hash", F.lit(1 << len(filters)).alias("bits"),
                                    F.lit(0).alias("n"))
    failed = (light.unionByName(again).groupBy("id", "part", "hash")
              .agg(F.bit_or("bits").alias("failed"), F.sum("n").alias("n")))
    marks = marks or {}
    if labels is not None:
        known = labels.groupBy(F.col(id_col).alias("label_id")).agg(
            *(F.max(F.coalesce(c, F.lit(False))).alias(f"is_{m}") for m, c in marks.items()))
        failed = failed.join(known, failed["id"] == known["label_id"], "left")
    assert len(letters) < 31
    return failed.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        *(F.sum(F.when(F.col(f"is_{m}"), F.col("n")).otherwise(0)).alias(m) for m in marks))


def orders(counts: DataFrame, letters: str, marks: dict[str, str]) -> DataFrame:
    """Every step of every order of the filters, per part, from the counts of combinations.

    ``marks`` maps a mark's column to its output column.  A part has at most
    two to the number of filters combinations, so their list is short.
    """
    own_list = F.collect_list(F.struct("failed", "n", *marks)).alias("found")
    every = ["".join(p) for p in permutations(letters)]
    steps = (counts.groupBy("part").agg(own_list)
             .select("part", "found", F.explode(F.array(*map(F.lit, every))).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")))
    # the filters before this step, and its own, as bits
    place = {x: F.instr("filter_order", x) for x in letters}
    before = sum((F.when(place[x] < F.col("step"), 1 << i).otherwise(0)
                  for i, x in enumerate(letters)), F.lit(0))
    own = sum((F.when(place[x] == F.col("step"), 1 << i).otherwise(0)
               for i, x in enumerate(letters)), F.lit(0))
    steps = steps.select("part", "found", "filter_order", "step", before.alias("before"),
                         own.alias("own"))

    def total(meets, value):
        return F.aggregate(F.filter("found", meets), F.lit(0).cast("long"),
                           lambda sum_, c: sum_ + value(c))

    def bits(c, which):
        return c["failed"].bitwiseAND(F.col(which))

    def here(c):
        return (bits(c, "own") != 0) & (bits(c, "before") == 0)

    # a filter is the first of j failing ones in this many of all orders
    share = F.lit(factorial(len(letters)))
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total(lambda c: (bits(c, "own") == 0) & (bits(c, "before") == 0),
              lambda c: c["n"]).alias("kept"),
        total(here, lambda c: c["n"]).alias("removed"),
        total(lambda c: (bits(c, "own") != 0) & (bits(c, "before") != 0),
              lambda c: c["n"]).alias("redundant"),
        total(lambda c: c["failed"] == F.col("own"), lambda c: c["n"]).alias("unique_fails"),
        *(total(here, lambda c, m=m: c[m]).alias(out) for m, out in marks.items()),
        total(lambda c: bits(c, "own") != 0,
              lambda c: c["n"] * (share / F.bit_count(c["failed"])).cast("long")).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: five filters over all documents, per source and in all 120 orders."""
    counts = combinations(table(spark, sf_dir, "documents"), text_filters(), "E",
                          marks={"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1},
                          labels=table(spark, sf_dir, "labels"))
    return orders(counts, "ABCDE", {"good": "good_lost", "toxic": "toxic_lost"})
