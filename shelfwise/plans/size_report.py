"""K6 sizes: ROAS and sales volume per day and shoe size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compact_to_date, is_integer_text
from ..functions.numbers import as_number, micros_to_units, ratio
from ..functions.text import clean_size, digits_and_dots, last_dash_token, offer_key
from ..operators.aggregates import cost_totals
from ..operators.currency import convert
from ..operators.filters import SHOES, ads_cost_projection, category_filter, fill_missing


def _analytics_size_rows(analytics: DataFrame, category: str = SHOES) -> DataFrame:
    """(date, size, itemRevenue, itemQuantity) rows."""
    an = category_filter(analytics, category)
    types = dict((f.name, f.dataType) for f in an.schema.fields)
    an = an.select(
        "date",
        clean_size("size").alias("size"),
        as_number("itemRevenue", types["itemRevenue"]).alias("itemRevenue"),
        as_number("itemQuantity", types["itemQuantity"], integral=True).alias("itemQuantity"),
    ).filter(is_integer_text("date"))
    return an.select(compact_to_date("date").alias("date"), digits_and_dots("size").alias("size"),
                     "itemRevenue", "itemQuantity")


def _ads_size_rows(ads: DataFrame) -> DataFrame:
    """(date, size, Cost in micros) rows."""
    ad = ads_cost_projection(ads)
    return ad.select(F.col("Date").alias("date"),
                     digits_and_dots(last_dash_token(offer_key("OfferID"))).alias("size"), "Cost")


def analytics_by_size(analytics: DataFrame, category: str = SHOES) -> DataFrame:
    """Revenue and quantity per (date, size)."""
    an = _analytics_size_rows(analytics, category)
    return an.groupBy("date", "size").agg(F.sum("itemRevenue").alias("itemRevenue"),
                                          F.sum("itemQuantity").alias("itemQuantity"))


def ads_by_size(ads: DataFrame, rates: DataFrame | None = None, from_ccy: str = "USD",
                to_ccy: str = "USD") -> DataFrame:
    """A13 + J12: cost per (date, size) in target units.

    Cost stays in integer micros through the sum and is converted once per
    group (conversion is linear, so this equals converting every row)."""
    daily = cost_totals(_ads_size_rows(ads), ["date", "size"])
    return daily.select("date", "size",
                        convert(micros_to_units("Cost"), rates, from_ccy, to_ccy).alias("Cost"))


def size_rows(ads: DataFrame, analytics: DataFrame, rates: DataFrame | None = None,
              from_ccy: str = "USD", to_ccy: str = "USD", category: str = SHOES) -> DataFrame:
    """Daily size analytics x daily size ad cost on (date, size)."""
    return analytics_by_size(analytics, category).join(ads_by_size(ads, rates, from_ccy, to_ccy),
                                                       ["date", "size"])


def sizes(ads: DataFrame, analytics: DataFrame, rates: DataFrame | None = None,
          from_ccy: str = "USD", to_ccy: str = "USD", category: str = SHOES,
          fill: float = -0.01) -> DataFrame:
    """A12 + A13 + J9 + A14 + P11 with one shuffle.

    Both sides are aggregated to (date, size) and inner-joined 1:1, so the
    join is a co-grouping: the two row sets are tagged, unioned and summed
    in one aggregation (map-side partial sums, one exchange), and keys seen
    on only one side -- or NULL -- are dropped, the inner join's rule.  The
    A14 sums over the 1:1 join are the identity."""
    an = _analytics_size_rows(analytics, category)
    ad = _ads_size_rows(ads)
    rev_t = dict(an.dtypes)["itemRevenue"]
    qty_t = dict(an.dtypes)["itemQuantity"]
    both = an.select("date", "size", "itemRevenue", "itemQuantity",
                     F.lit(None).cast("bigint").alias("Cost"),
                     F.lit(1).alias("_an"), F.lit(0).alias("_ad")).unionByName(
        ad.select("date", "size", F.lit(None).cast(rev_t).alias("itemRevenue"),
                  F.lit(None).cast(qty_t).alias("itemQuantity"), "Cost",
                  F.lit(0).alias("_an"), F.lit(1).alias("_ad")))
    per_key = both.groupBy("date", "size").agg(
        F.sum("itemRevenue").alias("itemRevenue"), F.sum("itemQuantity").alias("itemQuantity"),
        F.sum("Cost").alias("Cost"), F.max("_an").alias("_an"), F.max("_ad").alias("_ad"))
    matched = per_key.filter((F.col("_an") == 1) & (F.col("_ad") == 1)
                             & F.col("date").isNotNull() & F.col("size").isNotNull())
    cost = convert(micros_to_units("Cost"), rates, from_ccy, to_ccy)
    out = matched.select("date", "size", ratio("itemRevenue", cost).alias("ROAS"),
                         F.col("itemQuantity").alias("salesVolume"))
    return fill_missing(out, ["ROAS", "salesVolume"], fill)
