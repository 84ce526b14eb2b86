"""The ad performance report (CSV: a title line, a header, rows)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import monday_of
from .headers import by_own_header, file_lines, has_fields

# Report columns (with and without the offer id) and renames.
REPORT_COLUMNS = ["Day", "Item Id", "Product type (1st level)", "Impressions", "Clicks", "Cost",
                  "Account", "Total conv. value"]
RANGE_COLUMNS = ["Day", "Product type (1st level)", "Impressions", "Clicks", "Cost", "Account",
                 "Total conv. value"]
RENAMES = {"Item Id": "OfferID", "Day": "Date", "Product type (1st level)": "GID",
           "Total conv. value": "ConversionValue", "Account": "Account"}
TYPES = {"Date": "date", "Impressions": "bigint", "Clicks": "bigint", "Cost": "bigint",
         "ConversionValue": "double"}
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def parse_report(raw: DataFrame) -> DataFrame:
    """S3: keep data lines only (the title and header lines, possibly
    repeated per file, have no ISO day), rename, and type the values.
    Bad numbers become NULL instead of failing or dropping the row.
    Columns the report does not have are absent from the result."""
    rows = raw.filter(F.coalesce(F.col("Day").rlike(DAY_PATTERN), F.lit(False)))
    rows = rows.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in raw.columns})
    return rows.withColumns({c: F.col(c).try_cast(t) for c, t in TYPES.items() if c in rows.columns})


def report_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines of report files with the file each stands in."""
    return file_lines(spark, path)


def parse_lines(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """S3 from ``report_lines``: every file's values are named by that file's
    own header line (see ``by_own_header``); columns of ``lines`` named in
    ``keep`` go along."""
    is_data = F.col("value").rlike(DAY_PATTERN[:-1])
    return parse_report(by_own_header(lines, has_fields("Day", "Impressions"), is_data, REPORT_COLUMNS,
                                      "a report file", keep))


def read_ads(spark: SparkSession, path: str | Sequence[str], with_offer: bool | None = None) -> DataFrame:
    """Read report files as text columns named by each file's header line.
    ``with_offer`` forces a variant's fixed column order instead, for files
    that come without a header."""
    if with_offer is None:
        return parse_lines(report_lines(spark, path))
    cols = REPORT_COLUMNS if with_offer else RANGE_COLUMNS
    schema = StructType([StructField(c, StringType()) for c in cols])
    raw = spark.read.csv(path if isinstance(path, str) else list(path), schema=schema, header=False)
    return parse_report(raw)


def previous_week(run_date: _dt.date) -> tuple[_dt.date, _dt.date]:
    """The seven days starting with the previous Monday."""
    start = monday_of(run_date) - _dt.timedelta(days=7)
    return start, start + _dt.timedelta(days=6)


def last_week(ads: DataFrame, run_date: _dt.date) -> DataFrame:
    """Previous Monday..Sunday, no zero-impression rows, 8 fields."""
    start, end = previous_week(run_date)
    return select_range(ads, start, end).select(
        "Date", "OfferID", "GID", "Impressions", "Clicks", "Cost", "Account", "ConversionValue")


def select_range(ads: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Inclusive day range, no zero-impression rows (pushed to the scan)."""
    return ads.filter(F.col("Date").between(F.lit(start), F.lit(end)) & (F.col("Impressions") > 0))


def date_range(ads: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """S5 as pulled: the range selection without the offer id (7 fields)."""
    return select_range(ads, start, end).select(
        "Date", "GID", "Impressions", "Clicks", "Cost", "Account", "ConversionValue")
