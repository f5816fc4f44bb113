"""Reading yearly CSV tables whose columns drift from year to year.

Steps (blueprint ids in brackets):

* list the files of a folder or glob from Spark's file index (no scan);
* read the first line of one file per directory, all in one job, and map
  it to a layout [R1];
* read each layout's files in one ``spark.read.csv`` with an all-string
  schema carrying the literal header names and ``enforceSchema=False``, so
  a file whose header differs fails the job instead of landing values in
  the wrong columns [E1];
* rename by position to our names [R3], take the year from the file path
  [R2], ``try_cast`` the numbers [R5], and union the layouts by name, a
  missing column becoming null [R4].

Nothing is lost without a word: a line with too few or too many fields
keeps its raw text and has no values, a number that is no finite number in
range is null and named in ``bad_numbers``, a file without a year gives rows
of null year, and files that are not read are listed by ``skipped_files``.
"""

from __future__ import annotations

import posixpath
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ashgrid.sources.layouts import LAYOUTS, Layout, detect_layout

# A yearly table: .csv in any case, plain or in a compression Spark reads.
CSV_NAME = re.compile(r"\.csv(\.(gz|bz2|deflate))?$", re.IGNORECASE)
CSV_GLOB = "*.[cC][sS][vV]*"

# The year: a year=2019 directory, else ..._2019.csv, else the innermost
# directory with a number from 1900 to 2099 in its name.
YEAR_PATTERNS = (r"(?i)/year=(\d{4})/",
                 r"(?i)_(\d{4})\.csv(?:\.(?:gz|bz2|deflate))?$",
                 r"^.*(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])[^/]*/[^/]*$")

# Values from here on don't fit the exact sums; no area or percent is near it.
MAX_NUMBER = 1e25


def _all_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files under a folder / glob, from the file index (nothing is read);
    names starting with ``_`` or ``.`` are skipped, as Spark itself does."""
    # recursive lookup: leaf files only, no partition inference, so loose
    # files beside year=... folders are listed too
    return sorted(spark.read.format("text").option("recursiveFileLookup", "true")
                  .load(path).inputFiles())


def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """CSV files under a folder / glob.  Other files (a licence, a readme) are
    ignored; ``skipped_files`` names them."""
    return [f for f in _all_files(spark, path) if CSV_NAME.search(f)]


def skipped_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files under a folder / glob that are not read as yearly tables."""
    return [f for f in _all_files(spark, path) if not CSV_NAME.search(f)]


def _plain(path: str) -> str:
    """A path with one slash after its scheme (Spark writes one or three)."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def read_headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """file -> its first line, for all files in one job.

    The first line is the earliest row of the file's first block; rows of a
    block are numbered in reading order.
    """
    lines = (spark.read.text(files)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("n"))
             .where("start = 0"))
    first = lines.groupBy("file").agg(F.min_by("value", "n").alias("line"))
    found = {_plain(r["file"]): r["line"] for r in first.collect()}    # a row per file asked for
    return {f: found[_plain(f)] for f in files if _plain(f) in found}


def detect_layouts(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """layout id -> files.  The header of one file per directory decides for
    the directory (a writer puts one layout in a directory); every file is
    still checked against it when read, with ``enforceSchema=False``."""
    by_dir: dict[str, list[str]] = defaultdict(list)
    for f in files:
        key = posixpath.dirname(f) if "year=" in f else f
        by_dir[key].append(f)
    if not by_dir:
        return {}
    headers = read_headers(spark, [fs[0] for fs in by_dir.values()])
    groups: dict[str, list[str]] = defaultdict(list)
    for key in sorted(by_dir):
        first = by_dir[key][0]
        if first not in headers:
            raise ValueError(f"empty file {first}")
        groups[detect_layout(headers[first]).id].extend(by_dir[key])
    return dict(groups)


def string_schema(layout: Layout) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType(), True) for h in layout.header])


def year_from_path(path_col: F.Column) -> F.Column:
    """Year named by a file path, null if none is."""
    found = [F.nullif(F.regexp_extract(path_col, p, 1), F.lit("")) for p in YEAR_PATTERNS]
    return F.coalesce(*found).cast("int")


MALFORMED = "malformed_row"


def in_range(value: F.Column) -> F.Column:
    """The number if it is finite and fits the exact sums, else null."""
    return F.when(F.abs(value) < F.lit(MAX_NUMBER), value)     # false for NaN and infinity


def read_year(spark: SparkSession, files: str | list[str], layout: Layout | str,
              mode: str = "PERMISSIVE") -> DataFrame:
    """Files of one layout -> our column names, numbers typed, year and
    source file added.  Dates stay text here (``last_update_raw``).

    A file whose header is not the layout's fails the read in every mode.
    A row with too few or too many fields is kept in ``PERMISSIVE`` mode
    with its raw text in ``malformed_row`` and all fields but its index null, as
    values may stand in the wrong columns; ``FAILFAST`` stops at it instead.
    A number that is no finite number below ``MAX_NUMBER`` is null, and its
    column is named in ``bad_numbers``.
    """
    if isinstance(layout, str):
        layout = LAYOUTS[layout]
    schema = string_schema(layout)
    # with column pruning the parser looks at the wanted fields only, and takes
    # a line with a field too many or too few for a whole one
    reader = (spark.read.option("header", True).option("enforceSchema", False)
              .option("columnPruning", False).option("mode", mode))
    if mode == "PERMISSIVE":
        schema = schema.add(T.StructField(MALFORMED, T.StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    raw = reader.schema(schema).csv(files)
    df = raw.select("*", F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_modification_time").alias("source_time"))
    if mode == "PERMISSIVE":
        df = df.toDF(*layout.columns, MALFORMED, "source_file", "source_time")
    else:
        df = (df.toDF(*layout.columns, "source_file", "source_time")
              .withColumn(MALFORMED, F.lit(None).cast("string")))
    whole = F.col(MALFORMED).isNull()
    types = layout.types()
    text = {c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in types}
    typed = {c: in_range(text[c].try_cast(t)) if t == "double" else text[c].try_cast(t)
             for c, t in types.items()}
    bad = F.array_compact(F.array(*[
        F.when(text[c].isNotNull() & typed[c].isNull(), F.lit(c)) for c in types]))
    # the first field can't be shifted: the index tells where the line was
    columns = [F.when(whole | F.lit(c == "src_row"), typed.get(c, F.col(c))).alias(c)
               for c in layout.columns]
    columns += [F.col("source_file"), F.col("source_time"), F.col(MALFORMED),
                F.when(whole & (F.size(bad) > 0), bad).alias("bad_numbers")]
    if "yr" not in types:
        columns.append(year_from_path(F.col("source_file")).alias("yr"))
    return df.select(*columns, F.lit(layout.id).alias("layout"))


def union_years(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one layout becomes null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def read_totals(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """The published yearly totals: (area_total double, yr int, source_file,
    malformed_row, bad_numbers); a malformed line has neither value."""
    return read_year(spark, files, "LT").select("area_total", "yr", "source_file", MALFORMED,
                                                "bad_numbers")
