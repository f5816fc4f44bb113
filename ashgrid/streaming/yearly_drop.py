"""A new yearly table lands; the conformed table and totals follow.

Structured Streaming discovers the files: a ``binaryFile`` stream over the
landing folder with only the ``path`` column selected, so file contents are
never read by the stream itself.  Each micro-batch hands its new paths (a
list bounded by ``max_files_per_trigger``) to the batch ingest: layout
detection, typed per-layout reads, union, cleaning.

What a batch writes is keyed by year and source file, never by batch: the
rows of a file replace the rows of that file and of nothing else, so the
result does not depend on how files are dealt to batches, a batch run again
after a failure doubles nothing, and a new checkpoint loses nothing.

A *delivery* of a year is all its files in one folder.  With
``mode="replace_year"`` the delivery whose first file is newest is the year
(a corrected table lands in a folder of its own); older deliveries stay in
``landed`` and are left out of ``current_units`` and ``totals``.  With
``mode="append"`` all deliveries count.  ``deliveries`` holds one row a file:
its delivery, its time, its exact sum and its number of rows.  A batch reads
back the facts of its own files alone to write these rows, and recomputes the
totals of the years it touched from the rows of these years, so its cost does
not grow with the facts that landed before.

The checkpoint lives beside the sink unless one is named, so a restarted job
skips files it has already committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ashgrid.plans.yearly import EXACT, conform_units
from ashgrid.sources.yearly_csv import (CSV_GLOB, CSV_NAME, detect_layouts, read_totals, read_year,
                                        union_years, year_from_path)

# The binaryFile source's fixed schema (streams need it stated).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# What a batch reads of its own tables (stated, so that no job infers it).
_FILE_KEY = "yr int, source_key string, delivery string, source_time timestamp"
LANDED_FACTS = f"{_FILE_KEY}, area_total double"
DELIVERIES = f"{_FILE_KEY}, area_total {EXACT}, n_rows bigint"

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"    # Spark's folder name for null

# Settings of the stream's own session (a clone of the caller's): setting ->
# (Spark's default, ours).  A value that is not the default is left alone.  A
# small batch is split among all cores, and code that the JVM would interpret,
# being too long a method for its compiler, is generated in parts.
BATCH_SETTINGS = {"spark.sql.files.openCostInBytes": ("4194304", "1048576"),
                  "spark.sql.codegen.hugeMethodLimit": ("65535", "8000")}

MODES = ("replace_year", "append")


def _replace(df: DataFrame, path: str, *parts: str) -> None:
    """Overwrite exactly the partitions that ``df`` holds."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def _existing(spark: SparkSession, folders: list[str]) -> list[str]:
    """The folders that exist (a file without rows has none)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [hadoop.Path(f) for f in folders]
    return [f for f, p in zip(folders, paths) if p.getFileSystem(conf).exists(p)]


def _partitions(spark: SparkSession, table: str, schema: str, folders: list[str]) -> DataFrame:
    """These partition folders of a table; no other is listed."""
    found = _existing(spark, [f"{table}/{f}" for f in folders])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*found)


def _year_folder(yr: int | None) -> str:
    return f"yr={NULL_PARTITION if yr is None else yr}"


def _folder_of(path: str) -> F.Column:
    """The path up to its last slash."""
    name = F.substring_index(path, "/", -1)
    return F.left(F.col(path), F.length(path) - F.length(name) - F.lit(1))


def _by_file(facts: DataFrame) -> DataFrame:
    """One row a file: delivery, time, exact sum, number of rows."""
    return facts.groupBy("yr", "source_key").agg(
        F.min("delivery").alias("delivery"), F.min("source_time").alias("source_time"),
        F.sum(F.col("area_total").cast(EXACT)).alias("area_total"),
        F.count(F.lit(1)).alias("n_rows"))


def _year_totals(files: DataFrame, mode: str) -> DataFrame:
    """``yearly_total`` of the rows that count, from the sums of their files."""
    def summed(*by):
        return files.groupBy(*by).agg(
            F.min("source_time").alias("since"), F.sum("area_total").alias("area_total"),
            F.sum("n_rows").alias("n_rows"))

    if mode == "append":
        totals = summed("yr")
    else:
        newest = F.max_by(F.struct("area_total", "n_rows"), F.struct("since", "delivery"))
        totals = summed("yr", "delivery").groupBy("yr").agg(newest.alias("t")).select("yr", "t.*")
    return totals.select("yr", F.col("area_total").cast("double").alias("area_total"), "n_rows")


def _upgrade(spark: SparkSession, sink: str) -> None:
    """``deliveries`` of a sink begun before it held the files' sums, written anew."""
    if _existing(spark, [f"{sink}/deliveries"]):
        files = spark.read.schema(DELIVERIES).parquet(f"{sink}/deliveries")
        if not files.where("n_rows is null").isEmpty():
            _replace(_by_file(spark.read.schema(LANDED_FACTS).parquet(f"{sink}/landed")),
                     f"{sink}/deliveries", "yr", "source_key")


def _some_years(table: DataFrame, years: list[int | None] | None) -> DataFrame:
    """The table's partitions of these years alone; all of them without years."""
    if years is None:
        return table
    named = F.col("yr").isin([y for y in years if y is not None])
    return table.where(named | F.col("yr").isNull() if None in years else named)


def current_units(spark: SparkSession, sink: str, mode: str = "replace_year",
                  years: list[int | None] | None = None) -> DataFrame:
    """The conformed rows that count: of every year's newest delivery, or all.

    Which delivery is newest is told by ``deliveries``, one row a file; with
    ``years`` only the partitions of these years are read.
    """
    landed = _some_years(spark.read.parquet(f"{sink}/landed"), years)
    if mode == "replace_year":
        files = _some_years(spark.read.parquet(f"{sink}/deliveries"), years)
        since = files.groupBy("yr", "delivery").agg(F.min("source_time").alias("since"))
        newest = since.groupBy("yr").agg(
            F.max(F.struct("since", "delivery"))["delivery"].alias("delivery"))
        same = landed["yr"].eqNullSafe(newest["yr"]) & (landed["delivery"] == newest["delivery"])
        landed = landed.join(newest, same, "left_semi")
    return landed.drop("source_key", "delivery")


def _ingest_batch(sink: str, mode: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        for setting, (default, ours) in BATCH_SETTINGS.items():
            if session.conf.get(setting).rstrip("bB") == default:
                session.conf.set(setting, ours)
        landed = batch.select("path", year_from_path(F.col("source_file")).alias("yr"),
                              F.sha1("source_file").alias("source_key"))
        # bounded by max_files_per_trigger
        files = {r.path: r for r in landed.collect() if CSV_NAME.search(r.path)}
        if not files:
            return
        groups = detect_layouts(session, sorted(files))
        totals_files = groups.pop("LT", None)
        if groups:
            rows = union_years([read_year(session, fs, lid) for lid, fs in sorted(groups.items())])
            units = conform_units(rows).withColumns({
                "source_key": F.sha1("source_file"),
                "delivery": _folder_of("source_file"),
                # a number would be part of the generated code, compiled anew in every batch
                "ingest_batch": F.substring_index(
                    F.concat(F.lit(f"{epoch_id}/"), F.sha1("source_file")), "/", 1).cast("int")})
            _replace(units, f"{sink}/landed", "yr", "source_key")
            units_files = [files[f] for fs in groups.values() for f in fs]
            written = _partitions(session, f"{sink}/landed", LANDED_FACTS, [
                f"{_year_folder(r.yr)}/source_key={r.source_key}" for r in units_files])
            _replace(_by_file(written), f"{sink}/deliveries", "yr", "source_key")
            years = sorted({r.yr for r in units_files if r.yr is not None})
            of_years = _partitions(session, f"{sink}/deliveries", DELIVERIES,
                                   [_year_folder(y) for y in years])
            _replace(_year_totals(of_years, mode), f"{sink}/totals", "yr")
        if totals_files:
            published = read_totals(session, totals_files).withColumn(
                "source_key", F.sha1("source_file"))
            _replace(published, f"{sink}/published_totals", "source_key")
    return run


def start_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str | None = None,
                 available_now: bool = True, max_files_per_trigger: int = 10_000,
                 mode: str = "replace_year", processing_time: str = "1 minute") -> StreamingQuery:
    """Start the stream.  ``available_now`` processes what has landed and
    stops; otherwise it polls every ``processing_time``."""
    if mode not in MODES:
        raise ValueError(mode)
    sink = sink.rstrip("/")
    _upgrade(spark, sink)
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", str(max_files_per_trigger))
             .load(landing).select("path", F.col("_metadata.file_path").alias("source_file")))
    writer = (files.writeStream.foreachBatch(_ingest_batch(sink, mode))
              .option("checkpointLocation", checkpoint or f"{sink}/_ingest_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(spark: SparkSession, landing: str, sink: str,
                     checkpoint: str | None = None, mode: str = "replace_year", **kw) -> DataFrame:
    """Process everything that has landed, wait, return the conformed rows that count."""
    q = start_ingest(spark, landing, sink, checkpoint, available_now=True, mode=mode, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return current_units(spark, sink.rstrip("/"), mode)
