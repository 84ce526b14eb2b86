"""Currency conversion against a rates table (units per EUR)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_rates(rates: DataFrame) -> DataFrame:
    """Most recent rate per currency: one partial aggregation, no sort."""
    return rates.groupBy("currency").agg(F.max_by("per_eur", "rate_date").alias("per_eur"))


def convert(amount: Column, rates: DataFrame | None, from_ccy: str = "USD",
            to_ccy: str = "USD") -> Column:
    """amount / rate(from) * rate(to); identity when the currencies agree.

    The two rates are scalar subqueries: Spark evaluates each once and inlines
    the value, so the data side needs no join or shuffle.  Differing currencies
    without a rates table are an error here; a currency that the table does not
    have is an error when the query runs."""
    if from_ccy == to_ccy:
        return amount.cast("double")
    if rates is None:
        raise ValueError(f"converting {from_ccy} to {to_ccy} needs a rates table")
    latest = latest_rates(rates.filter(F.col("currency").isin(from_ccy, to_ccy)))

    def rate(ccy: str) -> Column:
        known = latest.filter(F.col("currency") == ccy).select("per_eur").scalar()
        return F.coalesce(known, F.raise_error(F.lit(f"no rate for currency {ccy}")).cast("double"))

    return amount.cast("double") / rate(from_ccy) * rate(to_ccy)
