"""The popular-products ranking (CSV with a header line)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..functions.dates import week_label
from ..operators.filters import drop_and_rename
from .headers import by_own_header, file_lines, has_fields

# Ranking report header, columns dropped, and renames.
RANKING_HEADER = [
    ("Popularity rank", IntegerType()),
    ("Change from last week", StringType()),
    ("Title", StringType()),
    ("GTIN", StringType()),
    ("Brand", StringType()),
    ("Brand inventory status", StringType()),
    ("Product inventory status", StringType()),
    ("Price range start", DoubleType()),
    ("Price range end", DoubleType()),
    ("Currency", StringType()),
    ("Category ID", StringType()),
    ("Category path", StringType()),
    ("Ranking category ID", StringType()),
    ("Ranking category path", StringType()),
]
DROPPED = ["Category ID", "Category path", "Ranking category ID", "Ranking category path", "Currency"]
RENAMES = {
    "Popularity rank": "Pop",
    "Change from last week": "ChangeFromLastWeek",
    "Brand inventory status": "BrandInventoryStatus",
    "Product inventory status": "ProductInventoryStatus",
    "Price range start": "PriceRangeStart",
    "Price range end": "PriceRangeEnd",
}
POPULAR_COLUMNS = ["Pop", "ChangeFromLastWeek", "Title", "GTIN", "Brand", "BrandInventoryStatus",
                   "ProductInventoryStatus", "PriceRangeStart", "PriceRangeEnd", "WeekNumber"]


def ranking_schema() -> StructType:
    return StructType([StructField(n, t) for n, t in RANKING_HEADER])


def cast_ranking(raw: DataFrame) -> DataFrame:
    """Rank as int, GTIN as text."""
    return raw.withColumns({"Popularity rank": F.col("`Popularity rank`").cast("int"),
                            "GTIN": F.col("GTIN").cast("string")})


def reported_gtin(raw: DataFrame, file: str) -> DataFrame:
    """GTIN in the form that a reader inferring column types per file gives.

    In a file whose codes are all whole numbers they lose leading zeros, and if
    one is missing all get the ending '.0' of a decimal column.  In other files
    the text stays.  A missing code is 'nan'.  ``file`` names the column that
    holds each row's file; one row per file is joined back."""
    whole = F.trim("GTIN").rlike(r"^[+-]?[0-9]{1,18}$")
    per_file = raw.groupBy(F.col(file).alias("_file")).agg(
        F.max(F.col("GTIN").isNull()).alias("_missing"),
        F.min(F.coalesce(whole, F.lit(True))).alias("_whole"))
    joined = raw.join(per_file, F.col(file) == F.col("_file"))
    number = F.trim("GTIN").try_cast("bigint").cast("string")
    form = (F.when(F.col("GTIN").isNull(), F.lit("nan")).when(~F.col("_whole"), F.col("GTIN"))
            .when(F.col("_missing"), F.concat(number, F.lit(".0"))).otherwise(number))
    return joined.withColumn("GTIN", form).drop("_file", "_missing", "_whole")


def normalize_ranking(raw: DataFrame, run_date: _dt.date, snap: bool = False) -> DataFrame:
    """S2 + P8 + P9 + P10: casts, drop the category and currency columns,
    stamp the report week and rename to the pipeline names.  No sort here:
    order matters only for the top-N cut (O2), which sorts by itself."""
    df = drop_and_rename(cast_ranking(raw), drop=[c for c in DROPPED if c in raw.columns], rename=RENAMES)
    return df.withColumn("WeekNumber", F.lit(week_label(run_date, snap))).select(*POPULAR_COLUMNS)


def ranking_lines(lines: DataFrame) -> DataFrame:
    """Ranking rows from the files' lines (value, file): the known columns,
    typed, and ``file``.  Every file's values are named by that file's own
    header line, so files of one read may differ in column order and in the
    columns they have; a column that a file lacks, and a value that does not
    parse, is NULL.  A file without a header is an error."""
    is_header = has_fields("Popularity rank", "GTIN")
    names = [name for name, _ in RANKING_HEADER]
    raw = by_own_header(lines.filter(F.trim("value") != ""), is_header, ~is_header, names, "a ranking file", keep=["file"])
    present = set(raw.columns)
    return raw.select("file", *[(F.col(f"`{name}`").try_cast(dtype) if name in present else F.lit(None).cast(dtype)).alias(name)
                                for name, dtype in RANKING_HEADER])


def read_ranking(spark: SparkSession, path: str | Sequence[str], run_date: _dt.date,
                 snap: bool = False, gtin_text: bool = False) -> DataFrame:
    """Read ranking CSV files by their header names (column order and extra
    columns do not matter, and may differ between files), typing each known
    column; a value that does not parse is NULL rather than an error.  GTINs
    take the per-file form of ``reported_gtin``, or stay the file's own text
    with ``gtin_text``."""
    typed = ranking_lines(file_lines(spark, path))
    return normalize_ranking(typed if gtin_text else reported_gtin(typed, "file"), run_date, snap)
