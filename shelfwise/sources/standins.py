"""Stand-in report tables derived from the driver's TPC-H-style tables.

The test data has no marketing tables, so the feed, the popularity ranking,
the ad report and the analytics report are views over ``part`` and
``events`` (rules fixed by FIXTURES.md section 2).  Each builder reads the
parquet once with only the columns it needs, so scans prune and push down.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import week_label
from ..operators.ordering import global_row_number

# Stand-in rules (FIXTURES.md section 2).
PRODUCT_GROUPS = 500          # product group = user_id % 500 and p_partkey % 500
GTIN_BASE = 100000000000      # GTIN = GTIN_BASE + p_partkey * 37
GTIN_STEP = 37
SIZES = 15                    # size = event_id % 15 followed by '.5'
AD_EVENT_TYPES = ("click", "view", "error")
ANALYTICS_EVENT_TYPES = ("purchase", "signup")
# Default run date of the weekly stand-in reports: a Monday inside the events range.
DEFAULT_RUN_DATE = _dt.date(2024, 1, 15)
# Run date whose four-week calendar is 2024-01-01 .. 2024-01-28.
DECLINE_RUN_DATE = _dt.date(2024, 1, 29)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Build each stand-in once per session and share it, as registering a
    view would: DataFrames are immutable and lazy, so every query that uses
    the same stand-in gets the same plan without rebuilding it."""
    cache = spark.__dict__.setdefault("_shelfwise_standins", {})
    if key not in cache:
        cache[key] = build()
    return cache[key]


def _group(c: str) -> F.Column:
    return (F.col(c) % PRODUCT_GROUPS).cast("string")


def _gtin() -> F.Column:
    return (F.lit(GTIN_BASE) + F.col("p_partkey") * GTIN_STEP).cast("string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the day and the value in integer cents."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id", "event_type",
        F.col("ts").cast("date").alias("dt"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def _build_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product feed: one row per variant, every field text (as XML gives it)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("g"), _group("p_partkey")).alias("GID"),
        F.concat(F.lit("G"), _group("p_partkey"), F.lit("-"), F.col("p_size").cast("string")).alias("ID"),
        _gtin().alias("GTIN"),
        F.concat(F.lit("img/"), (F.col("p_partkey") % 100).cast("string")).alias("IMG"),
        F.col("p_brand").alias("BRAND"),
        F.concat((F.col("p_partkey") % 4 * 10).cast("string"), F.lit("%")).alias("Margin"),
        F.col("p_size").cast("string").alias("Size"),
    )


def _popular_columns(run_date: _dt.date) -> list:
    return [
        F.col("Pop"),
        (F.col("p_partkey") % 7 - 3).cast("string").alias("ChangeFromLastWeek"),
        F.col("p_name").alias("Title"),
        F.concat(_gtin(), F.lit(".0")).alias("GTIN"),
        F.col("p_brand").alias("Brand"),
        F.when(F.col("p_partkey") % 2 == 0, "In stock").otherwise("Not in inventory").alias("BrandInventoryStatus"),
        F.when(F.col("p_partkey") % 3 == 0, "Not in inventory").otherwise("In stock").alias("ProductInventoryStatus"),
        F.col("p_retailprice").alias("PriceRangeStart"),
        (F.col("p_retailprice") + F.col("p_size")).alias("PriceRangeEnd"),
        F.lit(week_label(run_date)).alias("WeekNumber"),
    ]


def _rank_order() -> list:
    return [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]


_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]


def _build_popular(spark: SparkSession, sf_dir: str, run_date: _dt.date = DEFAULT_RUN_DATE) -> DataFrame:
    """Popularity ranking: Pop = 1-based rank by price desc, then part key.

    Every part gets its rank from its number among equal whole prices and the
    count of those before it (see ``global_row_number``), never one task.
    """
    p = table(spark, sf_dir, "part").select(*_PART_COLS)
    ranked = global_row_number(p, _rank_order(), -F.floor("p_retailprice"), "Pop")
    return ranked.select(*_popular_columns(run_date)).withColumn("Pop", F.col("Pop").cast("int"))


def _build_top(spark: SparkSession, sf_dir: str, n: int, run_date: _dt.date = DEFAULT_RUN_DATE) -> DataFrame:
    """The first ``n`` rows of the ranking, numbered after the cut: every task
    keeps its own first ``n`` parts, and only these are put in order."""
    top = table(spark, sf_dir, "part").select(*_PART_COLS).orderBy(*_rank_order()).limit(n)
    ranked = top.withColumn("Pop", F.row_number().over(Window.orderBy(*_rank_order())))
    return ranked.select(*_popular_columns(run_date))


def ranking_report(spark: SparkSession, sf_dir: str, run_date: _dt.date = DEFAULT_RUN_DATE) -> DataFrame:
    """The ranking as the report file names its columns (before S2)."""
    p = popular(spark, sf_dir, run_date)
    shoes = "Apparel & Accessories > Shoes"
    return p.select(
        F.col("Pop").alias("Popularity rank"),
        F.col("ChangeFromLastWeek").alias("Change from last week"),
        "Title", "GTIN", "Brand",
        F.col("BrandInventoryStatus").alias("Brand inventory status"),
        F.col("ProductInventoryStatus").alias("Product inventory status"),
        F.col("PriceRangeStart").alias("Price range start"),
        F.col("PriceRangeEnd").alias("Price range end"),
        F.lit("USD").alias("Currency"),
        F.lit("187").alias("Category ID"), F.lit(shoes).alias("Category path"),
        F.lit("187").alias("Ranking category ID"), F.lit(shoes).alias("Ranking category path"),
    )


def _build_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad performance report: one row per click/view/error event."""
    e = events(spark, sf_dir).filter(F.col("event_type").isin(*AD_EVENT_TYPES))
    return e.select(
        F.col("dt").alias("Date"),
        F.concat(F.lit("G"), _group("user_id"), F.lit(" shoes")).alias("GID"),
        F.concat(F.lit("G"), _group("user_id"), F.lit("-"), (F.col("event_id") % SIZES).cast("string"),
                 F.lit(".5|US")).alias("OfferID"),
        F.when(F.col("event_id") % 5 == 0, "ACCOUNT UK").otherwise("ACCOUNT US").alias("Account"),
        F.when(F.col("event_type") == "view", 40).otherwise(5).cast("bigint").alias("Impressions"),
        F.when(F.col("event_type") == "click", 30).otherwise(1).cast("bigint").alias("Clicks"),
        F.when(F.col("event_id") % 97 == 0, F.lit(0).cast("bigint"))
         .otherwise(F.col("cents") * 10000).alias("Cost"),
        (F.col("cents").cast("double") / 100).alias("ConversionValue"),
    )


def _build_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web analytics product report: one row per purchase/signup event."""
    e = events(spark, sf_dir).filter(F.col("event_type").isin(*ANALYTICS_EVENT_TYPES))
    return e.select(
        F.date_format("dt", "yyyyMMdd").alias("date"),
        F.when(F.col("event_id") % 11 == 0, "(not set)")
         .otherwise(F.concat(F.lit("Shoe "), _group("user_id"))).alias("productName"),
        F.concat(F.lit("g"), _group("user_id")).alias("productSku"),
        F.when(F.col("event_id") % 6 == 0, "Canada").otherwise("United States").alias("country"),
        F.concat(F.lit("US "), (F.col("event_id") % SIZES).cast("string"), F.lit(".5Wm")).alias("size"),
        F.when(F.col("event_id") % 7 == 0, "Bags").otherwise("Shoes").alias("productType"),
        F.col("cents").alias("itemRevenue"),
        (F.col("event_id") % 100).alias("buyToDetailRate"),
        (F.col("event_id") % 3 + 1).alias("itemQuantity"),
    )


def _build_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hit table for S8-S11: every event with its product, country, size,
    category and traffic source (source from the event's ``props.k``)."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.date_format(F.col("ts").cast("date"), "yyyyMMdd").alias("date"),
        "user_id", "event_type",
        F.when(F.col("event_id") % 11 == 0, "(not set)")
         .otherwise(F.concat(F.lit("Shoe "), _group("user_id"))).alias("productName"),
        F.concat(F.lit("g"), _group("user_id")).alias("productSku"),
        F.when(F.col("event_id") % 6 == 0, "Canada").otherwise("United States").alias("country"),
        F.concat(F.lit("US "), (F.col("event_id") % SIZES).cast("string"), F.lit(".5Wm")).alias("size"),
        F.when(F.col("event_id") % 7 == 0, "Bags").otherwise("Shoes").alias("productType"),
        F.when(k % 3 == 0, "google / cpc").otherwise("google / organic").alias("sourceMedium"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        (F.col("event_id") % 3 + 1).alias("quantity"),
    )


# Euro reference rates for the stand-in currency table
# (rate_date, currency, units per EUR).
RATES = (
    (_dt.date(2024, 1, 2), "USD", 1.0956),
    (_dt.date(2024, 1, 2), "GBP", 0.86518),
    (_dt.date(2024, 1, 2), "EUR", 1.0),
    (_dt.date(2024, 1, 29), "USD", 1.0823),
    (_dt.date(2024, 1, 29), "GBP", 0.8526),
    (_dt.date(2024, 1, 29), "EUR", 1.0),
)


def rates(spark: SparkSession) -> DataFrame:
    """Currency table (rate_date, currency, per_eur): a small reference table."""
    return spark.createDataFrame(list(RATES), "rate_date date, currency string, per_eur double")


# Public builders: shared per session (see ``_shared``).

def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product feed: one row per variant, every field text (as XML gives it)."""
    return _shared(spark, ("feed", sf_dir), lambda: _build_feed(spark, sf_dir))


def popular(spark: SparkSession, sf_dir: str, run_date: _dt.date = DEFAULT_RUN_DATE) -> DataFrame:
    """Popularity ranking: Pop = 1-based rank by price desc, then part key."""
    return _shared(spark, ("popular", sf_dir, run_date), lambda: _build_popular(spark, sf_dir, run_date))


def popular_top(spark: SparkSession, sf_dir: str, n: int, run_date: _dt.date = DEFAULT_RUN_DATE) -> DataFrame:
    """The first ``n`` rows of ``popular``."""
    return _shared(spark, ("popular-top", sf_dir, n, run_date), lambda: _build_top(spark, sf_dir, n, run_date))


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad performance report: one row per click/view/error event."""
    return _shared(spark, ("ads", sf_dir), lambda: _build_ads(spark, sf_dir))


def analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web analytics product report: one row per purchase/signup event."""
    return _shared(spark, ("analytics", sf_dir), lambda: _build_analytics(spark, sf_dir))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hit table for S8-S11."""
    return _shared(spark, ("hits", sf_dir), lambda: _build_hits(spark, sf_dir))
