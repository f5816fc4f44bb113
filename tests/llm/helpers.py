"""Documents with every awkward case, and small readers."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} of a very long text" for i in range(20_000))
#: Texts that are long without the breaks prose has.
UNBROKEN = ["x" * 50_000, " " * 50_000, "漢字かな" * 10_000, "token: " * 8_000, "a@" * 20_000]
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, None), (3, ""), (4, " \n\t "), (5, "!!! ??? ###"), (6, "one two"),
    (7, "Ünïcode ÄÖÜ ñandú — “quoted” 漢字 😀 é"), (8, LONG),
    (9, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (10, "repeated row"), (10, "repeated row"), (None, "a row without id"),
]
#: Names that operators use for their own columns.
CLASHING = ("score", "predicted", "spans", "size", "shard", "slot", "ids", "key", "bands", "first",
            "label", "item", "item_id", "evidence", "id", "rank", "links", "n_chars", "fingerprint",
            "first_id", "first_hash", "Text_Hash", "bad_id", "bad_hash", "__first", "__hash",
            "__text_hash", "__text", "__key", "scored_text", "hash", "part", "bits", "failed", "n",
            "form", "position", "piece", "k1", "anchor", "stretch", "found", "text_key", "repeats")


def odd_docs(spark):
    """ROWS with extra columns whose names clash with the operators' own."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return docs.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHING))


def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def read(sf_dir, name, *columns):
    """Columns of a table as Python lists, by ascending first column."""
    t = pq.read_table(f"{sf_dir}/{name}.parquet", columns=list(columns)).sort_by(columns[0])
    return [t[c].to_pylist() for c in columns]


def words(text):
    """Words by a pattern: runs of letters and digits of the lower-cased text."""
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(text, n=5):
    """Set of runs of n words; a shorter text has one run."""
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}
