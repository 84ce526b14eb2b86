"""K7 / K8: the dashboard views over the do_sell table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.aggregates import avg_pop_per_id, first_min_pop, view_rollup
from ..operators.joins import keep_keys
from ..sources.sinks import append_table

VIEW_COLUMNS = ["ID", "Impressions", "newCost", "Clicks", "ConversionValue", "CTR", "IMG", "BRAND",
                "Pop", "itemRev", "BTDR", "ROAS", "productName", "country"]


def products_with_min_pop(do_sell: DataFrame, period: str) -> DataFrame:
    """A15 + J10 + A16 as written: IDs having a row whose Pop is one of the
    per (ID, period, year) minima (the IN-list is uncorrelated, so it is the
    set of all minima; Pop values are top-N ranks, so it has at most N
    values).  Kept as the literal operator; the views use the one-pass form
    below."""
    minima = first_min_pop(do_sell, period).select("Pop").distinct()
    rows = keep_keys(do_sell, minima, "Pop")
    return avg_pop_per_id(rows)


def do_sell_by_period(do_sell: DataFrame, period: str, period_alias: str,
                      round_clicks: bool) -> DataFrame:
    """J11 + A17 in one pass over the table.

    The CTE keeps an ID exactly when the ID has a row with a non-NULL Pop:
    such a row's group (ID, period, year) has a non-NULL minimum, which is
    the Pop of a row of the same ID and so is in the IN-list; conversely a
    qualifying row has a non-NULL Pop.  So instead of scanning the table
    three times (minima, IN-filter, join back) we aggregate once, carrying
    COUNT(Pop) per output group, and keep the groups of IDs whose counts sum
    above zero.  That sum is a window over the aggregated rows (one per
    period, brand, name and country of an ID -- never raw rows), so the table
    is read once; a second branch over the same aggregate would be pruned
    differently and recompute everything upstream."""
    # The roll-up combines map-side before its exchange, so an ID that holds a
    # large share of the history is a few partial rows per task; the per-ID
    # window then moves only rolled-up rows.
    rolled = view_rollup(do_sell, period, period_alias, round_clicks, with_pop_count=True)
    per_id = F.sum("_pop_rows").over(Window.partitionBy("ID"))
    out = rolled.withColumn("_n", per_id).filter(F.col("_n") > 0)
    return out.select(*VIEW_COLUMNS, period_alias, "YearNum")


def do_sell_by_month(do_sell: DataFrame) -> DataFrame:
    """K7: monthly roll-up (clicks rounded; the month column is named Monthum)."""
    return do_sell_by_period(do_sell, "monthNum", "Monthum", round_clicks=True)


def do_sell_by_week(do_sell: DataFrame) -> DataFrame:
    """K8: weekly roll-up."""
    return do_sell_by_period(do_sell, "WeekNumber", "WeekNum", round_clicks=False)


# ------------------------------------------------- K7 / K8 from stored states

# The measures that the views average, and as what.
_MEASURES = {"Impressions": "Impressions", "newCost": "newCost", "Clicks": "Clicks", "ConversionValue": "ConversionValue",
             "Pop": "Pop", "itemRev": "itemRev", "buyToDetailRate": "BTDR", "newROAS": "ROAS"}
_GROUP = ["yearNum", "ID", "BRAND", "productName", "country"]


def view_states(do_sell: DataFrame, period: str, also: Sequence[str] = ()) -> DataFrame:
    """The view's groups as states that merge: per ``period``, year, ID, BRAND,
    productName and country the sum and the count of every averaged measure
    and the largest IMG.  ``also`` adds grouping columns, such as the report
    Monday by which states are stored and replaced."""
    sums = [F.sum(m).alias(f"{m}_sum") for m in _MEASURES]
    counts = [F.count(m).alias(f"{m}_n") for m in _MEASURES]
    return do_sell.groupBy(*also, period, *_GROUP).agg(*sums, *counts, F.max("IMG").alias("IMG"))


def store_view_states(do_sell_week: DataFrame, path: str, period: str, week: str = "report_monday") -> None:
    """Write the states of one or more report weeks of the do_sell table,
    replacing what is stored of these weeks and nothing else: the views are
    kept up to date by the new week's rows alone."""
    append_table(view_states(do_sell_week, period, [week]), path, [week], replace_partitions=True)


def view_from_states(states: DataFrame, period: str, period_alias: str, round_clicks: bool) -> DataFrame:
    """K7 / K8 merged from ``view_states`` rows of any weeks; the do_sell table
    is not read."""
    merged = states.groupBy(period, *_GROUP).agg(
        *[F.sum(f"{m}_sum").alias(f"{m}_sum") for m in _MEASURES],
        *[F.sum(f"{m}_n").alias(f"{m}_n") for m in _MEASURES], F.max("IMG").alias("IMG"))
    per_id = F.sum("Pop_n").over(Window.partitionBy("ID"))
    mean = {m: F.try_divide(F.col(f"{m}_sum").cast("double"), F.col(f"{m}_n").cast("double")) for m in _MEASURES}
    mean["buyToDetailRate"] = mean["buyToDetailRate"] / 100
    out = merged.withColumn("_n", per_id).filter(F.col("_n") > 0).select(
        period, *_GROUP, "IMG", *[v.alias(_MEASURES[m]) for m, v in mean.items()])
    out = out.withColumn("CTR", F.try_divide("Clicks", "Impressions"))
    if round_clicks:
        out = out.withColumn("Clicks", F.round("Clicks", 0))
    return out.withColumnsRenamed({period: period_alias, "yearNum": "YearNum"}).select(*VIEW_COLUMNS, period_alias, "YearNum")


def do_sell_by_month_from_states(states: DataFrame) -> DataFrame:
    """K7 from the states by ``monthNum``."""
    return view_from_states(states, "monthNum", "Monthum", round_clicks=True)


def do_sell_by_week_from_states(states: DataFrame) -> DataFrame:
    """K8 from the states by ``WeekNumber``."""
    return view_from_states(states, "WeekNumber", "WeekNum", round_clicks=False)
