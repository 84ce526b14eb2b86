"""Incremental report ingestion with Structured Streaming.

The weekly job pulls new report files and appends them to the warehouse
tables.  Here a landing folder receives the raw report files (ad report CSV
or analytics JSON responses); a file-source stream with
``trigger(availableNow=True)`` processes every file not seen by an earlier
run -- the checkpoint remembers which -- and stops, so a scheduler can start
it once a week.

Each micro-batch is written into a partition of its own, named by the
stream's id and the batch's number, with dynamic partition overwrite.  A
batch re-run after a failure replaces its own output; other streams into the
same table, and a stream that starts anew with a fresh checkpoint, have other
ids and never touch it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.ads import parse_lines
from ..sources.analytics import flatten_responses, read_lines, rename_fields

Parse = Callable[[DataFrame], DataFrame]


def file_lines_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The lines of new files in ``landing``, with the file each stands in.  A
    file is never split between micro-batches."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(landing).select("value", F.col("_metadata.file_path").alias("file"))


def ads_report_stream(spark: SparkSession, landing: str,
                      max_files_per_trigger: int | None = None) -> tuple[DataFrame, Parse]:
    """New ad report files: the stream of their lines and the S3 parsing of a
    micro-batch, which names each file's values by its own header."""
    return file_lines_stream(spark, landing, max_files_per_trigger), parse_lines


def analytics_response_stream(spark: SparkSession, landing: str, fields: Sequence[str],
                              renames: dict | None = None,
                              max_files_per_trigger: int | None = None) -> tuple[DataFrame, Parse]:
    """New analytics response files (JSON lines): the stream of their lines and
    the parsing into a flat report (S6 + S7).  A bad document is an error."""
    def parse(lines: DataFrame) -> DataFrame:
        flat = flatten_responses(read_lines(lines), fields)
        return rename_fields(flat, renames) if renames else rename_fields(flat)

    return file_lines_stream(spark, landing, max_files_per_trigger), parse


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def append_new_files(source: tuple[DataFrame, Parse], table_path: str, checkpoint: str,
                     partition_by: Sequence[str] = (), fmt: str = "parquet") -> StreamingQuery:
    """Run the stream over everything new, append it to ``table_path`` and
    stop.  Returns the finished query (its progress reports row counts)."""
    stream, parse = source
    parts = ["ingest_stream", "ingest_batch", *partition_by]

    def write(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(batch.sparkSession, checkpoint)
        (parse(batch).withColumns({"ingest_stream": F.lit(own), "ingest_batch": F.lit(batch_id)})
         .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).save(table_path))

    query = (stream.writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
