"""Overlapping pulls of report days: the newest pull of a day counts.

A weekly job pulls 28 days every week, so three of four pulled days were
pulled before, and later pulls correct them.  ``land_pulls`` ingests new files
with an available-now stream into two tables:

* ``<table>/versions``: every pull as it came, partitioned by day, pull and
  micro-batch;
* ``<table>/days``: of each day the rows of its newest pull, partitioned by day.

A micro-batch first lands its versions and then renews the days it touched from
the versions.  Both are dynamic partition overwrites of what the batch decides
by itself, so a replayed batch changes nothing; an older pull that comes late
renews its days to the rows they had; a pull that comes in several files or
batches is united."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..sources.ads import parse_lines
from ..sources.analytics import flatten_responses, read_lines, rename_fields
from ..sources.sinks import write_table
from .ingest import file_lines_stream, stream_id

PULL = "pull"
_OWN = ["ingest_stream", "ingest_batch"]
Parse = Callable[[DataFrame, Sequence[str]], DataFrame]


def pull_folder(file: Column) -> Column:
    """The pull of a file in a folder ``pull=<name>``; names are compared as
    text, so dates (2024-01-15) or padded numbers sort rightly."""
    return F.regexp_extract(file, r"/pull=([^/]+)/", 1)


def ads_pulls(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> tuple[DataFrame, Parse]:
    """New ad report files below ``landing`` and their parsing (S3)."""
    return file_lines_stream(spark, f"{landing.rstrip('/')}/*", max_files_per_trigger), parse_lines


def analytics_pulls(spark: SparkSession, landing: str, fields: Sequence[str],
                    max_files_per_trigger: int | None = None) -> tuple[DataFrame, Parse]:
    """New analytics responses below ``landing`` and their parsing."""
    def parse(lines: DataFrame, keep: Sequence[str]) -> DataFrame:
        return rename_fields(flatten_responses(read_lines(lines, keep), fields, keep))

    return file_lines_stream(spark, f"{landing.rstrip('/')}/*", max_files_per_trigger), parse


def newest_pulls(versions: DataFrame, day: str) -> DataFrame:
    """The rows of each day's newest pull, each file's once.  The pulls of the
    days come from the partition columns alone: one row a day is joined back.
    A file that a second stream (a fresh checkpoint) landed again counts as
    that stream landed it."""
    newest = versions.select(day, PULL).groupBy(day).agg(F.max(PULL).alias(PULL))
    rows = versions.join(F.broadcast(newest), [day, PULL], "left_semi")
    landed = F.max(F.struct(*_OWN)).alias("_l")
    last = rows.groupBy(day, "file").agg(landed).select(day, "file", *[F.col(f"_l.{c}").alias(c) for c in _OWN])
    return rows.join(last, [day, "file", *_OWN], "left_semi")


def land_pulls(source: tuple[DataFrame, Parse], table: str, checkpoint: str, day: str = "Date",
               pull_of: Callable[[Column], Column] = pull_folder) -> StreamingQuery:
    """Run the stream over everything new, renew ``<table>/days`` and stop.

    ``pull_of`` makes a file's pull from its path; a file without one is an
    error.  A day that a newer pull has no row of keeps the older pull's rows:
    a report without rows does not say which days it covers."""
    stream, parse = source
    versions_path, days_path = f"{table.rstrip('/')}/versions", f"{table.rstrip('/')}/days"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "true")     # a stream's session has it off; these are batch jobs
        stream_name = stream_id(spark, checkpoint)
        pull = pull_of(F.col("file"))
        named = F.when(F.coalesce(pull, F.lit("")) == "", F.raise_error(
            F.concat(F.lit("no pull in the path "), F.col("file")))).otherwise(pull)
        rows = parse(batch.withColumn(PULL, named), [PULL, "file"])
        parts = dict(zip(_OWN, (F.lit(stream_name), F.lit(batch_id))))
        write_table(rows.withColumns(parts), versions_path, [day, PULL, *_OWN], mode="overwrite",
                    partitionOverwriteMode="dynamic")
        stored = _versions(spark, versions_path, rows.schema)
        if stored is None:                            # nothing but headers so far
            return
        landed = stored.filter((F.col("ingest_stream") == stream_name) & (F.col("ingest_batch") == batch_id))
        touched = [r[day] for r in landed.select(day).distinct().collect()]
        if not touched:
            return
        renewed = newest_pulls(stored.filter(F.col(day).isin(touched)), day)
        write_table(renewed.select(*[c for c in rows.columns if c != "file"]), days_path, [day], mode="overwrite",
                    partitionOverwriteMode="dynamic")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def _versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    whole = StructType([*schema.fields, *[StructField(c, t) for c, t in zip(_OWN, (StringType(), LongType()))]])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException:
        return None


def read_days(spark: SparkSession, table: str) -> DataFrame:
    """The days table: report rows with the pull (text) that each came from."""
    return spark.read.parquet(f"{table.rstrip('/')}/days")
