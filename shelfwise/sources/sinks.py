"""Append sinks for the report tables and a CSV dump."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: About how many bytes a written file gets before compression.
TARGET_BYTES = 256 << 20

_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def rebalanced(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` dealt out by ``partition_by`` for writing: a partition folder
    gets about as many files as its bytes need, and not one from every task.
    Adaptive execution joins small pieces and splits a large one (a day that
    holds most rows) at the session's advisory size."""
    return df.hint("rebalance", *partition_by)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                mode: str = "append", target_bytes: int | None = TARGET_BYTES, **options: str) -> None:
    """Write ``df``, rebalanced to files of about ``target_bytes`` (None: as
    its tasks have it).  The write is a job of its own: files are committed by
    Spark's output committer, so a lost executor only retries tasks."""
    spark = df.sparkSession
    writer = (rebalanced(df, partition_by) if target_bytes else df).write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _setting(spark, _ADVISORY, str(target_bytes or TARGET_BYTES)):
        writer.save(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 fmt: str = "parquet", replace_partitions: bool = False,
                 target_bytes: int | None = TARGET_BYTES) -> None:
    """Append a report to its table folder.

    A plain append duplicates rows when a week is re-run; with
    ``replace_partitions`` the written partitions (e.g. report_monday) are
    replaced instead (dynamic partition overwrite) and every other partition
    is kept.  Replacing needs ``partition_by``: without it the whole table
    would go.  Spark infers a partition column's type from its folder names
    when the table is read, so partition by dates and keep text labels as data
    columns.  Partition folders get files of about ``target_bytes``."""
    if replace_partitions and not partition_by:
        raise ValueError("replace_partitions needs partition_by: without partitions it would replace the whole table")
    if replace_partitions:
        write_table(df, path, partition_by, fmt, "overwrite", target_bytes, partitionOverwriteMode="dynamic")
    else:
        write_table(df, path, partition_by, fmt, "append", target_bytes)


def append_catalog_table(df: DataFrame, table: str, partition_by: Sequence[str] = (),
                         replace_partitions: bool = False, target_bytes: int | None = TARGET_BYTES) -> None:
    """S12 into a catalog table (created on first use).  With
    ``replace_partitions`` the written partitions of an existing table are
    replaced and all others kept; the table must be partitioned."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if replace_partitions and not (partition_by or exists):
        raise ValueError("replace_partitions needs partition_by: without partitions it would replace the whole table")
    rows = rebalanced(df, partition_by) if target_bytes else df
    with _setting(spark, _ADVISORY, str(target_bytes or TARGET_BYTES)):
        if not (replace_partitions and exists):
            writer = rows.write.mode("append")
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
            return
        columns = spark.catalog.listColumns(table)
        if not any(c.isPartition for c in columns):
            raise ValueError(f"{table} has no partitions to replace")
        with _setting(spark, _OVERWRITE, "dynamic"):  # a table's insert has no option for it
            rows.select(*[f"`{c.name}`" for c in columns]).write.mode("overwrite").insertInto(table)


def dump_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line (one folder of part files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)
