"""K5 margins: ROAS and sales volume per day and discount margin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.dates import compact_to_date, is_integer_text
from ..functions.numbers import as_number, micros_to_units, ratio
from ..functions.text import before_first_space
from ..operators.aggregates import cost_totals, distinct_rows
from ..operators.currency import convert


def margin_feed(feed: DataFrame) -> DataFrame:
    """S1 margins projection + F8 + A10: distinct (Margin, GID, Brand)."""
    fd = feed.select("Margin", F.lower("GID").alias("GID"), F.col("BRAND").alias("Brand"))
    return distinct_rows(fd, ["Margin", "GID", "Brand"])


def analytics_feed_rows(analytics: DataFrame, feed: DataFrame) -> DataFrame:
    """J7 as rows: analytics (integer dates, lower-cased SKU) x distinct
    (Margin, GID, Brand) on SKU -- one row per analytics row and variant."""
    an = analytics.filter(is_integer_text("date")).select(
        compact_to_date("date").alias("date"), F.lower("productSku").alias("productSku"),
        "productName", "itemRevenue", "itemQuantity")
    fd = margin_feed(feed).withColumnRenamed("GID", "productSku")
    return an.join(fd, "productSku").select("Margin", "Brand", "date", "itemQuantity", "productSku",
                                            "productName", "itemRevenue")


def with_daily_cost(rows: DataFrame, ads: DataFrame, lower_ads_gid: bool = False) -> DataFrame:
    """J8 as rows: J7 rows x the day's ad cost (A9) on date and SKU = GID."""
    gid = before_first_space("GID")
    ad = ads.select(F.col("Date").alias("date"), (F.lower(gid) if lower_ads_gid else gid).alias("productSku"),
                    "Cost")
    return rows.join(cost_totals(ad, ["date", "productSku"]), ["date", "productSku"])


def margins(feed: DataFrame, ads: DataFrame, analytics: DataFrame, rates: DataFrame | None = None,
            from_ccy: str = "USD", to_ccy: str = "USD", lower_ads_gid: bool = False) -> DataFrame:
    """J7 (analytics x feed on SKU), J8 (x daily ad cost on date and GID),
    J12, A11 (per margin and day: SUM(revenue) / SUM(cost), SUM(quantity)).

    The joins fan rows out -- every (Margin, Brand) variant of a GID repeats
    the analytics row and its day's cost, and that double counting is part
    of the result.  Instead of materialising the fan-out, each input is
    reduced to its join key and the sums are weighted by partner counts:
    revenue x variants, cost x analytics rows x variants.  Analytics and ad
    cost share the key (date, GID), so they are co-grouped in one union and
    one aggregation; the feed contributes variant counts per (GID, Margin).
    Same sums, no row explosion, one row per key in every shuffle.

    ``lower_ads_gid`` lower-cases the ad GIDs before the SKU comparison; by
    default they are compared as the report spells them.
    """
    types = dict((f.name, f.dataType) for f in analytics.schema.fields)
    an = analytics.filter(is_integer_text("date")).select(
        compact_to_date("date").alias("date"),
        F.lower("productSku").alias("GID"),
        as_number("itemRevenue", types["itemRevenue"]).alias("rev"),
        as_number("itemQuantity", types["itemQuantity"], integral=True).alias("qty"),
    )
    gid = before_first_space("GID")
    ad = ads.select(F.col("Date").alias("date"), (F.lower(gid) if lower_ads_gid else gid).alias("GID"), "Cost")

    # J8 co-grouped: analytics per (date, SKU) and the day's cost per
    # (date, GID) (A9) come from one union and one aggregation; keys with
    # rows on both sides (and no NULL) are the inner join's matches.
    rev_t, qty_t = dict(an.dtypes)["rev"], dict(an.dtypes)["qty"]
    both = an.select("date", "GID", "rev", "qty", F.lit(None).cast("bigint").alias("Cost"),
                     F.lit(1).alias("_an"), F.lit(0).alias("_ad")).unionByName(
        ad.select("date", "GID", F.lit(None).cast(rev_t).alias("rev"), F.lit(None).cast(qty_t).alias("qty"),
                  "Cost", F.lit(0).alias("_an"), F.lit(1).alias("_ad")))
    per_key = both.groupBy("date", "GID").agg(
        F.sum("rev").alias("rev"), F.sum("qty").alias("qty"), F.sum("_an").alias("n_rows"),
        F.sum("Cost").alias("Cost"), F.max("_ad").alias("_ad"))
    matched = per_key.filter((F.col("n_rows") > 0) & (F.col("_ad") == 1)
                             & F.col("date").isNotNull() & F.col("GID").isNotNull())

    fd_k = margin_feed(feed).groupBy("GID", "Margin").agg(F.count(F.lit(1)).alias("n_variants"))
    joined = matched.join(fd_k, "GID")
    # Integer sums are exact; weighted by row and variant counts they may pass
    # 64 bits, so the weights are applied in 38-digit decimals.
    wide = {c: F.col(c).cast("decimal(38,0)") if isinstance(joined.schema[c].dataType, IntegralType) else F.col(c)
            for c in ("rev", "qty", "Cost")}
    weight = F.col("n_variants").cast("decimal(20,0)")
    per_margin = joined.groupBy("Margin", "date").agg(
        F.sum(wide["rev"] * weight).alias("rev"),
        F.sum(wide["Cost"] * F.col("n_rows").cast("decimal(20,0)") * weight).alias("cost_micros"),
        F.sum(wide["qty"] * weight).cast("bigint").alias("salesVolume"),
    )
    new_cost = convert(micros_to_units("cost_micros"), rates, from_ccy, to_ccy)
    return per_margin.select("date", "Margin", ratio("rev", new_cost).alias("ROAS"), "salesVolume")
