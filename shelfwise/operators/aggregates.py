"""Aggregations (A1-A17).  Every one is a hash aggregate with a map-side
partial step, so a hot key is combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AD_METRICS = ("Impressions", "Clicks", "Cost", "ConversionValue")


def ads_totals(ads: DataFrame, keys: Sequence[str], metrics: Sequence[str] = AD_METRICS) -> DataFrame:
    """Ad metrics summed per keys (GID, Account, period, year)."""
    return ads.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics])


def analytics_totals(analytics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Revenue summed and buy-to-detail rate averaged per keys."""
    return analytics.groupBy(*keys).agg(
        F.sum("itemRevenue").alias("itemRevenue"),
        F.avg("buyToDetailRate").alias("buyToDetailRate"),
    )


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3 / A10: distinct projection (GROUP BY without aggregates)."""
    return df.select(*cols).distinct()


def dedup_matches(rows: DataFrame) -> DataFrame:
    """A4: one row per (GID, metrics, IMG, month, year, Pop); BRAND is not a
    grouping key, so the smallest one is kept (deterministic, T4)."""
    return rows.groupBy("GID", "Impressions", "Cost", "Clicks", "ConversionValue", "IMG",
                        "monthNum", "yearNum", "Pop").agg(F.min("BRAND").alias("BRAND"))


def match_totals(rows: DataFrame) -> DataFrame:
    """A5: metrics summed per (GID, IMG, Pop, month, year), BRAND as in A4."""
    return rows.groupBy("GID", "IMG", "Pop", "monthNum", "yearNum").agg(
        *[F.sum(m).alias(m) for m in AD_METRICS], F.min("BRAND").alias("BRAND"))


def clicks_per_gid(ads: DataFrame) -> DataFrame:
    """Clicks summed per product group."""
    return ads.groupBy("GID").agg(F.sum("Clicks").alias("Clicks"))


def cost_totals(ads: DataFrame, keys: Sequence[str], col: str = "Cost") -> DataFrame:
    """Cost summed per keys (kept in integer micros)."""
    return ads.groupBy(*keys).agg(F.sum(col).alias(col))


def first_min_pop(do_sell: DataFrame, period: str) -> DataFrame:
    """MIN(Pop) per (ID, period, YearNum)."""
    return do_sell.groupBy("ID", period, "yearNum").agg(F.min("Pop").alias("Pop"))


def avg_pop_per_id(rows: DataFrame) -> DataFrame:
    """The view's CTE x -- AVG(Pop) per ID."""
    return rows.groupBy("ID").agg(F.avg("Pop").alias("avg_pop"))


def view_rollup(rows: DataFrame, period: str, period_alias: str, round_clicks: bool,
                with_pop_count: bool = False) -> DataFrame:
    """The dashboard roll-up per (period, year, ID, BRAND, productName, country).
    ``with_pop_count`` adds ``_pop_rows`` = COUNT(Pop) for the view's ID filter."""
    clicks: Column = F.avg("Clicks")
    if round_clicks:
        clicks = F.round(clicks, 0)
    extra = [F.count("Pop").alias("_pop_rows")] if with_pop_count else []
    return rows.groupBy(period, "yearNum", "ID", "BRAND", "productName", "country").agg(
        F.avg("Impressions").alias("Impressions"),
        F.avg("newCost").alias("newCost"),
        clicks.alias("Clicks"),
        F.avg("ConversionValue").alias("ConversionValue"),
        F.try_divide(F.avg("Clicks"), F.avg("Impressions")).alias("CTR"),
        F.max("IMG").alias("IMG"),
        F.avg("Pop").alias("Pop"),
        F.avg(F.col("itemRev").cast("double")).alias("itemRev"),
        F.avg(F.col("buyToDetailRate").cast("double") / 100).alias("BTDR"),
        F.avg(F.col("newROAS").cast("double")).alias("ROAS"),
        *extra,
    ).withColumnsRenamed({period: period_alias, "yearNum": "YearNum"})
