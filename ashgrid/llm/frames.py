"""Small helpers the operators share: inputs, Arrow maps, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ashgrid.session import checkpoint_root, scratch_path

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kind(df: DataFrame, column: str) -> str:
    """The column's type as a DDL string."""
    return df.schema[column].dataType.simpleString()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that ``df`` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_hash_mod(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Like ``--py-files``: the driver serves the zipped sources, so executors
    need no copy of the repository.
    """
    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"   # read by the driver only
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``df.mapInArrow`` of a function that gets one non-empty batch."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from make(batch)
                # Arrow's pool else keeps what the largest batch needed
                pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet below the shared checkpoint folder and read back.

    Cuts the lineage: what follows never recomputes ``df``, also when an
    executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
