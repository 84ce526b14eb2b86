"""Currency reference rates (units per EUR) for J12.

Reads the euro reference-rate history as published: a wide CSV with a
``Date`` column and one column per currency, 'N/A' where a currency has no
rate that day.  It is unpivoted into (rate_date, currency, per_eur) rows,
plus EUR = 1.0 for every date, which is what ``operators.currency`` joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .headers import by_own_header, file_lines, has_fields


def unpivot_rates(wide: DataFrame, date_col: str = "Date") -> DataFrame:
    """Wide (date, USD, GBP, ...) text columns -> long typed rows."""
    currencies = [c for c in wide.columns if c != date_col and c.strip()]
    long = wide.unpivot([date_col], currencies, "currency", "value")
    long = long.select(F.to_date(F.trim(date_col)).alias("rate_date"),
                       F.trim("currency").alias("currency"),
                       F.trim("value").try_cast("double").alias("per_eur"))
    long = long.filter(F.col("per_eur").isNotNull() & F.col("rate_date").isNotNull())
    eur = long.select("rate_date").distinct().select("rate_date", F.lit("EUR").alias("currency"),
                                                     F.lit(1.0).alias("per_eur"))
    return long.unionByName(eur)


def read_rates(spark: SparkSession, path: str | Sequence[str], date_col: str = "Date") -> DataFrame:
    """Read the rate history CSV file(s).  Every file's values are named by its
    own header line, so files may list other currencies or in another order; a
    currency that a file lacks has no rate from it."""
    lines = file_lines(spark, path).filter(F.trim("value") != "")
    is_header = has_fields(date_col)
    wide = by_own_header(lines, is_header, ~is_header, [date_col], "a rates file")
    return unpivot_rates(wide, date_col)
