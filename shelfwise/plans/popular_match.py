"""K1 do_sell, K2 not_sold, K3 popular: the popular-products match."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compact_to_date, is_integer_text, month_str, week_label, year_str
from ..functions.numbers import as_number, micros_to_units, roas
from ..functions.text import before_first_space
from ..operators.aggregates import ads_totals, analytics_totals, distinct_rows
from ..operators.currency import convert
from ..operators.filters import (UNITED_STATES, US_ACCOUNT, account_filter, country_filter,
                                 not_in_inventory)
from ..operators.joins import gtin_pairs, lower_key_join
from ..operators.ordering import TOP_N, top_n

POPULAR_COLUMNS = ["Pop", "ChangeFromLastWeek", "Title", "GTIN", "Brand", "BrandInventoryStatus",
                   "ProductInventoryStatus", "PriceRangeStart", "PriceRangeEnd", "WeekNumber"]
DO_SELL_COLUMNS = ["ID", "Impressions", "Cost", "Clicks", "ConversionValue", "IMG", "BRAND", "Pop",
                   "itemRev", "buyToDetailRate", "productName", "country", "monthNum", "yearNum",
                   "newCost", "newROAS", "WeekNumber"]


def popular_top(popular: DataFrame, n: int = TOP_N) -> DataFrame:
    """K3: the top-``n`` ranking rows as they are appended."""
    return top_n(popular, n).select(*POPULAR_COLUMNS)


def not_sold(popular: DataFrame, n: int = TOP_N) -> DataFrame:
    """K2: top-``n`` products the shop has no inventory of."""
    return not_in_inventory(top_n(popular, n))


def monthly_ads(ads: DataFrame, account: str | None = US_ACCOUNT) -> DataFrame:
    """F8, P1, F1, F2, F7 -> A1: ad metrics per (GID, Account, month, year)."""
    adw = account_filter(ads, account) if account is not None else ads
    adw = adw.select(
        before_first_space(F.lower("GID")).alias("GID"), "Account",
        month_str("Date").alias("monthNum"), year_str("Date").alias("yearNum"),
        "Impressions", "Clicks", "Cost", "ConversionValue")
    return ads_totals(adw, ["GID", "Account", "monthNum", "yearNum"])


def monthly_analytics(analytics: DataFrame, country: str = UNITED_STATES) -> DataFrame:
    """P6, F1, F2, P3 -> A2: revenue and BTDR per (country, SKU, name, month, year)."""
    types = dict((f.name, f.dataType) for f in analytics.schema.fields)
    an = analytics.filter(is_integer_text("date")).withColumn("_d", compact_to_date("date"))
    an = country_filter(an, country).select(
        "country", "productSku", "productName",
        month_str("_d").alias("monthNum"), year_str("_d").alias("yearNum"),
        as_number("itemRevenue", types["itemRevenue"]).alias("itemRevenue"),
        as_number("buyToDetailRate", types["buyToDetailRate"]).alias("buyToDetailRate"))
    return analytics_totals(an, ["country", "productSku", "productName", "monthNum", "yearNum"])


def matched_products(feed: DataFrame, ads_m: DataFrame, popular: DataFrame, n: int = TOP_N,
                     feed_drop: int = 2, rank_drop: int = 4, clean: bool = False,
                     one_account: bool = False) -> DataFrame:
    """J1 -> J2 -> A3 -> J3 -> A4 -> A5: ad metrics per (GID, IMG, Pop, month, year).

    The literal chain joins every feed variant to every month of ads, joins
    that to the ranking, deduplicates, joins back and sums.  Because all
    joins are on GID we reduce each input to its per-GID distinct content
    before the joins and get the same rows:

    * (Pop, GID) pairs from the feed's GTINs x the top-N ranking
      (the J2 match; GIDs without ads drop out in the final join);
    * per (GID, month, year) the sum of the *distinct* metric tuples (A4
      groups on the metric values, so equal tuples of two accounts count
      once, and A5 then sums them).  With ``one_account`` the ad totals
      already hold one tuple per (GID, month, year), so both steps are the
      identity and are skipped -- two shuffles fewer on the largest input;
    * per (GID, IMG) the smallest BRAND (A4's bare BRAND, made deterministic).
    """
    fd = feed.select(F.lower("GID").alias("GID"), "GTIN", "IMG", "BRAND")
    ranking = top_n(popular, n).select("Pop", "GTIN")
    pairs = gtin_pairs(fd, ranking, feed_drop, rank_drop, clean)
    if one_account:
        ads_sum = ads_m.drop("Account")
    else:
        metric_tuples = distinct_rows(
            ads_m, ["GID", "monthNum", "yearNum", "Impressions", "Cost", "Clicks", "ConversionValue"])
        ads_sum = ads_totals(metric_tuples, ["GID", "monthNum", "yearNum"])
    img_brand = fd.groupBy("GID", "IMG").agg(F.min("BRAND").alias("BRAND"))
    return ads_sum.join(img_brand, "GID").join(pairs, "GID")


def do_sell(feed: DataFrame, ads: DataFrame, analytics: DataFrame, popular: DataFrame,
            run_date: _dt.date, n: int = TOP_N, account: str | None = US_ACCOUNT,
            country: str = UNITED_STATES, rates: DataFrame | None = None,
            from_ccy: str = "USD", to_ccy: str = "USD", feed_drop: int = 2, rank_drop: int = 4,
            clean: bool = False, snap: bool = False) -> DataFrame:
    """K1: matched products x monthly analytics (J4), cost converted (J12,
    F15), ROAS (F16) and the report week label (P10)."""
    ads_m = monthly_ads(ads, account)
    products = matched_products(feed, ads_m, popular, n, feed_drop, rank_drop, clean,
                                one_account=account is not None)
    an_m = monthly_analytics(analytics, country)
    joined = lower_key_join(products, an_m.withColumnRenamed("itemRevenue", "itemRev"),
                            "GID", "productSku", also=["monthNum", "yearNum"])
    new_cost = convert(micros_to_units("Cost"), rates, from_ccy, to_ccy)
    out = joined.withColumnsRenamed({"GID": "ID"}).withColumn("newCost", new_cost)
    out = out.withColumns({"newROAS": roas("itemRev", "newCost"),
                           "WeekNumber": F.lit(week_label(run_date, snap))})
    return out.select(*DO_SELL_COLUMNS)
