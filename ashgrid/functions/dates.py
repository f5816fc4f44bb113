"""Dates written in more than one format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date formats found in the yearly tables.
DATE_FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd")


def parse_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that parses wins; text that fits none becomes null
    (``try_to_date`` never raises, even with ANSI mode on)."""
    col = F.col(c) if isinstance(c, str) else c
    col = F.nullif(F.trim(col), F.lit(""))
    return F.coalesce(*[F.try_to_date(col, f) for f in formats])
