"""Projections and filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_integer_text

# Labels the reports filter on.
US_ACCOUNT = "ACCOUNT NAME"
NOT_IN_INVENTORY = "Not in inventory"
UNITED_STATES = "United States"
SHOES = "Shoes"
NOT_SET = "(not set)"
FILL_VALUE = -0.01

NOT_SOLD_COLUMNS = ["Pop", "ChangeFromLastWeek", "Title", "GTIN", "Brand",
                    "PriceRangeStart", "PriceRangeEnd", "WeekNumber"]


def account_filter(ads: DataFrame, account: str = US_ACCOUNT) -> DataFrame:
    """Rows of one ad account."""
    return ads.filter(F.col("Account") == account)


def not_in_inventory(popular: DataFrame, status: str = NOT_IN_INVENTORY) -> DataFrame:
    """Popular products the shop does not stock, by popularity."""
    return (popular.filter(F.col("ProductInventoryStatus") == status)
            .select(*NOT_SOLD_COLUMNS).orderBy("Pop"))


def country_filter(df: DataFrame, country: str = UNITED_STATES) -> DataFrame:
    """Rows of one country."""
    return df.filter(F.col("country") == country)


def category_filter(analytics: DataFrame, category: str = SHOES) -> DataFrame:
    """One product category, five columns."""
    return (analytics.filter(F.col("productType") == category)
            .select("date", "productSku", "size", "itemRevenue", "itemQuantity"))


def having_clicks_over(totals: DataFrame, threshold: int = 400, col: str = "Clicks") -> DataFrame:
    """P5: keep groups whose summed clicks exceed the threshold."""
    return totals.filter(F.col(col) > threshold)


def integer_dates(df: DataFrame, col: str = "date") -> DataFrame:
    """Drop rows whose date is not an integer (repeated header lines)."""
    return df.filter(is_integer_text(col))


def drop_not_set(df: DataFrame, col: str = "productName", label: str = NOT_SET) -> DataFrame:
    """Drop '(not set)' names, keeping NULL names."""
    return df.filter(~F.col(col).eqNullSafe(label))


def drop_and_rename(df: DataFrame, drop: Iterable[str] = (), rename: dict | None = None) -> DataFrame:
    """Drop columns, then rename."""
    out = df.drop(*drop)
    return out.withColumnsRenamed(rename) if rename else out


def with_label(df: DataFrame, name: str, value: str) -> DataFrame:
    """P10: constant text label column (WeekNumber, WeekRange)."""
    return df.withColumn(name, F.lit(value))


def fill_missing(df: DataFrame, cols: Iterable[str], value: float = FILL_VALUE) -> DataFrame:
    """Fill NULLs with a float.  Columns are cast to double first so the
    fill value is not truncated to the column's integer type."""
    cols = list(cols)
    out = df.withColumns({c: F.col(c).cast("double") for c in cols})
    return out.fillna(value, subset=cols)


def ads_cost_projection(ads: DataFrame) -> DataFrame:
    """Date, OfferID and Cost of the ad report."""
    return ads.select("Date", "OfferID", "Cost")
