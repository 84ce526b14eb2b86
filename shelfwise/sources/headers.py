"""CSV lines bound to the header line of their own file."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Files whose header is sent to every task (a path and a line each).
BROADCAST_FILES = 200_000


def file_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines of text files with the file each stands in."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def has_fields(*names: str) -> Column:
    """Whether the line has all ``names`` among its fields."""
    found = F.lit(True)
    for name in names:
        found = found & F.col("value").rlike(rf'(^\x{{FEFF}}?|,)\s*"?{name}"?\s*(,|$)')
    return found


def _fields(header: str) -> list[str]:
    return [f.strip() for f in next(csv.reader([header.removeprefix("\ufeff")]))]


def by_own_header(lines: DataFrame, is_header: Column, is_data: Column, columns: Sequence[str], what: str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """The rows of ``lines`` (value, file) as text columns named by the header
    line of their file, wherever it stands: files of one read may differ in
    column order and variant.  ``columns`` come first where some file has them,
    then the other fields; a column that only some files have is null for the
    others.  Columns of ``lines`` named in ``keep`` go along and hide equal
    fields.

    A file with ``is_data`` lines but without a header, or with two different
    headers, is an error.  Without any header the rows are none and have all
    ``columns``.

    Only the distinct header lines reach the driver (one per report
    definition, not per file); the files' headers are broadcast while they are
    few."""
    heads = lines.filter(is_header).groupBy("file").agg(F.min("value").alias("header"), F.max("value").alias("_other"))
    definitions = heads.groupBy("header").agg(F.count(F.lit(1)).alias("files"),
                                              F.sum((F.col("header") != F.col("_other")).cast("int")).alias("mixed")).collect()
    if any(d["mixed"] for d in definitions):
        raise ValueError(f"{what} has two different header lines")
    if not definitions:
        if not lines.filter(is_data).isEmpty():
            raise ValueError(f"no header line in {what}")
        return lines.filter(F.lit(False)).select(*keep, *[F.lit(None).cast("string").alias(c) for c in columns])
    heads = heads.select("file", "header")
    few = sum(d["files"] for d in definitions) <= BROADCAST_FILES
    tagged = lines.filter(~is_header).join(F.broadcast(heads) if few else heads, "file", "left")
    names = {d["header"]: _fields(d["header"]) for d in sorted(definitions, key=lambda d: d["header"])}
    present = dict.fromkeys([*columns, *(f for fields in names.values() for f in fields if f)])
    present = [c for c in present if c not in keep and any(c in fields for fields in names.values())]
    values = F.lit(None)
    for header, fields in names.items():
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(fields))])
        parsed = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
        ordered = F.struct(*[(parsed[f"c{fields.index(c)}"] if c in fields else F.lit(None).cast("string")).alias(c)
                             for c in present])
        values = F.when(F.col("header") == header, ordered).otherwise(values)
    headless = F.col("header").isNull() & is_data
    checked = F.when(headless, F.raise_error(F.concat(F.lit("no header line in "), F.col("file")))).otherwise(values)
    return tagged.select(*keep, checked.alias("_r")).select(*keep, "_r.*")
