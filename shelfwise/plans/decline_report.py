"""K4 decline: products whose ROAS fell by half over four weeks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import (compact_to_date, four_week_calendar, is_integer_text, report_days, week_number,
                               week_range_label, year_str)
from ..functions.numbers import as_number, micros_to_units, roas
from ..functions.text import before_first_space
from ..operators.aggregates import ads_totals, analytics_totals
from ..operators.currency import convert
from ..operators.filters import UNITED_STATES, country_filter, drop_not_set
from ..operators.joins import lower_key_join
from ..operators.windows import DECLINE_PERCENT, decline_rule

DECLINE_COLUMNS = ["ID", "Impressions", "Cost", "Clicks", "ConversionValue", "itemRev",
                   "buyToDetailRate", "productName", "country", "weekNum", "yearNum", "newCost",
                   "newROAS", "WeekRange"]


def weekly_ads(ads: DataFrame, days: list[_dt.date] | None, min_clicks: int = 400) -> DataFrame:
    """S5, F2, F3, F7 -> A6 + P5 -> A7 -> J6: weekly ad totals of the product
    groups with more than ``min_clicks`` clicks over the whole period.
    ``days=None`` takes every row given (the caller already selected them)."""
    adw = ads.filter(F.col("Impressions") > 0)
    if days is not None:
        adw = adw.filter(F.col("Date").between(F.lit(days[0]), F.lit(days[-1])))
    adw = adw.select(before_first_space("GID").alias("GID"), "Account",
                     year_str("Date").alias("yearNum"), week_number("Date").alias("weekNum"),
                     "Impressions", "Clicks", "Cost", "ConversionValue")
    weekly = ads_totals(adw, ["GID", "Account", "weekNum", "yearNum"])
    # A6 + P5 + J6 from the weekly totals: they partition the same rows, so
    # their per-GID sums equal the raw per-GID sums.  The sum is a window over
    # the weekly rows (a handful per GID: weeks x accounts), so the ads are
    # scanned and aggregated once.
    period_clicks = F.sum("Clicks").over(Window.partitionBy("GID"))
    return (weekly.withColumn("_period_clicks", period_clicks)
            .filter(F.col("_period_clicks") > min_clicks).drop("_period_clicks"))


def weekly_analytics(analytics: DataFrame, days: list[_dt.date] | None,
                     country: str = UNITED_STATES) -> DataFrame:
    """The 28 daily pulls (S-side day selection), lower-cased names, P6,
    F2, F3, P3 -> A8: revenue and BTDR per (country, SKU, name, week, year)."""
    types = dict((f.name, f.dataType) for f in analytics.schema.fields)
    an = analytics.filter(is_integer_text("date"))
    if days is not None:
        an = report_days(an, days)
    an = an.withColumn("_d", compact_to_date("date"))
    an = country_filter(an, country).select(
        "country", "productSku", F.lower("productName").alias("productName"),
        week_number("_d").alias("weekNum"), year_str("_d").alias("yearNum"),
        as_number("itemRevenue", types["itemRevenue"]).alias("itemRevenue"),
        as_number("buyToDetailRate", types["buyToDetailRate"]).alias("buyToDetailRate"))
    return analytics_totals(an, ["country", "productSku", "productName", "weekNum", "yearNum"])


def weekly_matches(ads: DataFrame, analytics: DataFrame, days: list[_dt.date] | None,
                   min_clicks: int = 400, country: str = UNITED_STATES,
                   cluster_by_gid: bool = False) -> DataFrame:
    """Weekly ads x weekly analytics on LOWER(GID) = LOWER(SKU), week and
    year; one row per metric combination with MIN(productName).

    ``cluster_by_gid`` hash-partitions the (already aggregated) joined rows
    by GID before the grouping: the grouping accepts that partitioning (GID
    is one of its keys), and so does a following per-product window, which
    then needs no exchange of its own."""
    ads_w = weekly_ads(ads, days, min_clicks)
    an_w = weekly_analytics(analytics, days, country).withColumnRenamed("itemRevenue", "itemRev")
    joined = lower_key_join(ads_w, an_w, "GID", "productSku", also=["weekNum", "yearNum"])
    if cluster_by_gid:
        joined = joined.repartition("GID")
    return joined.groupBy(
        F.col("GID").alias("ID"), "Impressions", "Cost", "Clicks", "ConversionValue", "itemRev",
        "buyToDetailRate", "country", "weekNum", "yearNum",
    ).agg(F.min("productName").alias("productName"))


def price(rows: DataFrame, rates: DataFrame | None = None, from_ccy: str = "USD",
          to_ccy: str = "USD") -> DataFrame:
    """J12 + F15 + F16: newCost in target units and newROAS."""
    priced = rows.withColumn("newCost", convert(micros_to_units("Cost"), rates, from_ccy, to_ccy))
    return priced.withColumn("newROAS", roas("itemRev", "newCost"))


def decline(ads: DataFrame, analytics: DataFrame, run_date: _dt.date, min_clicks: int = 400,
            percent: float = DECLINE_PERCENT, country: str = UNITED_STATES,
            rates: DataFrame | None = None, from_ccy: str = "USD", to_ccy: str = "USD",
            order_by_year: bool = False, snap: bool = False) -> DataFrame:
    """K4: J5 (weekly ads x weekly analytics on lower GID, week, year, one
    row per metric combination with MIN(productName)), P7, J12/F16, W1, O3
    and the WeekRange label (P10)."""
    days = four_week_calendar(run_date, snap)
    grouped = drop_not_set(weekly_matches(ads, analytics, days, min_clicks, country, cluster_by_gid=True))
    priced = price(grouped, rates, from_ccy, to_ccy)
    kept = decline_rule(priced, percent=percent, order_by_year=order_by_year)
    return (kept.withColumn("WeekRange", F.lit(week_range_label(days)))
            .select(*DECLINE_COLUMNS).orderBy("ID", "weekNum"))
