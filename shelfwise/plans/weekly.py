"""The weekly job: every report for one run date, appended to its table.

Inputs are DataFrames from the sources (they may hold more days than a run
needs); each report gets the day selection it uses -- last calendar week of
ads, the seven report days of analytics, the four-week calendar for the
decline report -- and is appended to ``<out>/<table>``.  Every table is
partitioned by ``report_monday``, the Monday of the reported week, so with
``replace=True`` a re-run replaces that week of that year and nothing else;
the text labels (WeekNumber, yearNum, ...) stay data columns and keep their
type.

``run_weekly`` first lands each source once, as parquet partitioned by day
under the output folder, and every report reads the landed days it needs: the
raw files are parsed once however many reports use them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace as with_changes

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import four_week_calendar, report_days, reporting_week
from ..operators.filters import US_ACCOUNT
from ..operators.ordering import TOP_N
from ..sources.ads import last_week, previous_week, select_range
from ..sources.sinks import append_table, write_table
from .decline_report import decline
from .margin_report import margins
from .popular_match import do_sell, not_sold, popular_top
from .size_report import sizes
from .views import do_sell_by_month, do_sell_by_week


@dataclass
class WeeklyInputs:
    feed: DataFrame                 # S1 default projection plus Margin (GID, ID, GTIN, IMG, BRAND, Margin)
    ranking: DataFrame              # S2 normalised ranking
    ads: DataFrame                  # S3 ad report rows (any days)
    analytics: DataFrame            # S6/S7 product report rows (any days)
    analytics_sizes: DataFrame      # S9 report with size and category (any days)
    rates: DataFrame | None = None  # currency table, needed when currencies differ


def weekly_reports(inputs: WeeklyInputs, run_date: _dt.date, *, top: int = TOP_N,
                   account: str = US_ACCOUNT, from_ccy: str = "USD", to_ccy: str = "USD",
                   snap: bool = False, feed_drop: int = 2, rank_drop: int = 4,
                   clean: bool = False) -> dict[str, DataFrame]:
    """The six report tables for ``run_date`` (nothing is executed here).
    ``feed_drop``, ``rank_drop`` and ``clean`` set the GTIN match of do_sell."""
    week = reporting_week(run_date, snap)
    ads_week = last_week(inputs.ads, run_date)
    an_week = report_days(inputs.analytics, week)
    sizes_week = report_days(inputs.analytics_sizes, week)
    calendar = four_week_calendar(run_date, snap)
    ads_4w = select_range(inputs.ads, calendar[0], calendar[-1])
    an_4w = report_days(inputs.analytics, calendar)
    money = dict(rates=inputs.rates, from_ccy=from_ccy, to_ccy=to_ccy)
    return {
        "do_sell": do_sell(inputs.feed, ads_week, an_week, inputs.ranking, run_date, n=top,
                           account=account, snap=snap, feed_drop=feed_drop, rank_drop=rank_drop,
                           clean=clean, **money),
        "not_sold": not_sold(inputs.ranking, top),
        "popular": popular_top(inputs.ranking, top),
        "decline": decline(ads_4w, an_4w, run_date, snap=snap, **money),
        "margins": margins(inputs.feed, ads_week, an_week, **money),
        "sizes": sizes(ads_week, sizes_week, **money),
    }


REPORT_MONDAY = "report_monday"


def for_week(report: DataFrame, run_date: _dt.date, snap: bool = False) -> DataFrame:
    """``report`` with the Monday of the reported week, the partition of every
    weekly table."""
    return report.withColumn(REPORT_MONDAY, F.lit(reporting_week(run_date, snap)[0]))


def land_inputs(inputs: WeeklyInputs, run_date: _dt.date, folder: str, snap: bool = False) -> WeeklyInputs:
    """Write each source once as parquet below ``folder`` and return inputs
    that read it: the reports' days only, partitioned by day, so that each
    report's day selection prunes folders.  Rows are dealt out by day before
    they are written, so a day has about as many files as its bytes need.
    Landing again replaces."""
    spark = inputs.feed.sparkSession
    days = sorted({*four_week_calendar(run_date, snap), *reporting_week(run_date, snap)})
    start = min(days[0], previous_week(run_date)[0])
    ads = select_range(inputs.ads, start, max(days[-1], previous_week(run_date)[1]))

    def landed(name: str, df: DataFrame, day: str | None = None) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        write_table(df, path, [day] if day else [], mode="overwrite")
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)

    same = inputs.analytics is inputs.analytics_sizes
    analytics = landed("analytics", report_days(inputs.analytics, days), "date")
    return with_changes(
        inputs, feed=landed("feed", inputs.feed), ranking=landed("ranking", inputs.ranking),
        ads=landed("ads", ads, "Date"), analytics=analytics,
        analytics_sizes=analytics if same else landed("analytics_sizes", report_days(
            inputs.analytics_sizes, reporting_week(run_date, snap)), "date"))


def run_weekly(inputs: WeeklyInputs, run_date: _dt.date, out: str, *, replace: bool = False,
               land: bool = True, **options) -> dict[str, str]:
    """Compute and append every weekly report; returns table -> path.  The
    sources are landed below ``<out>/_landed`` first unless ``land`` is off."""
    paths = {}
    snap = options.get("snap", False)
    if land:
        inputs = land_inputs(inputs, run_date, f"{out.rstrip('/')}/_landed/{run_date}", snap)
    sc = inputs.feed.sparkSession.sparkContext
    for name, report in weekly_reports(inputs, run_date, **options).items():
        path = f"{out.rstrip('/')}/{name}"
        sc.setJobDescription(f"shelfwise weekly {name} {run_date}")
        try:
            append_table(for_week(report, run_date, snap), path, partition_by=[REPORT_MONDAY],
                         replace_partitions=replace)
        finally:
            sc.setJobDescription(None)
        paths[name] = path
    return paths


def register_views(spark, out: str, fmt: str = "parquet") -> list[str]:
    """The dashboard views over the appended do_sell table: temp views
    ``do_sell`` (the table), ``do_sell_by_month`` and ``do_sell_by_week``,
    re-read on every query like a warehouse view."""
    table = spark.read.format(fmt).load(f"{out.rstrip('/')}/do_sell")
    table.createOrReplaceTempView("do_sell")
    do_sell_by_month(table).createOrReplaceTempView("do_sell_by_month")
    do_sell_by_week(table).createOrReplaceTempView("do_sell_by_week")
    return ["do_sell", "do_sell_by_month", "do_sell_by_week"]
