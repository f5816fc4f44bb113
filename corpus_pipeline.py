"""From raw documents to piece ids of clean, different documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as parquet and read again as the next stage's documents.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ashgrid.llm import decontamination, jaccard, personal, pieces, toxicity
from ashgrid.llm.frames import saved, table

#: Labelled rows that the toxicity index holds at most.
MAX_EXAMPLES = toxicity.MAX_EXAMPLES


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples don't call toxic."""
    every = table(spark, sf_dir, "documents")
    sample = toxicity.labelled_sample(every, table(spark, sf_dir, "labels"), MAX_EXAMPLES)
    return toxicity.drop_toxic(docs, toxicity.fit(sample, every))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every near-duplicate class."""
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal.redact_all(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", redact),
    ("sentencepiece", encode),
]

#: SQL can't express a fitted classifier, hashing, alignment or merging.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
