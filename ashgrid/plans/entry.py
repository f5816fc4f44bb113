"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    ids: str          # blueprint ids covered
    run: Query
    sql: str | None   # DuckDB oracle; None -> rows-only check
