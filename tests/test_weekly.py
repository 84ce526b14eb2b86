"""The weekly job over the stand-in tables: six tables, re-runs idempotent."""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfwise.plans.weekly import WeeklyInputs, register_views, run_weekly
from shelfwise.sources import fixtures as FX
from shelfwise.sources import standins as S
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _count(spark, path):
    # an empty report writes no data files, so there is nothing to read back
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def _inputs(spark):
    an = S.analytics(spark, SF)
    return WeeklyInputs(feed=S.feed(spark, SF), ranking=S.popular(spark, SF),
                        ads=S.ads(spark, SF), analytics=an, analytics_sizes=an)


def test_weekly_job_writes_six_tables_and_reruns_replace(spark):
    out = FX.scratch_path(spark, "weekly")
    run = dt.date(2024, 1, 15)
    paths = run_weekly(_inputs(spark), run, out, account="ACCOUNT US")
    counts = {k: _count(spark, p) for k, p in paths.items()}
    assert set(counts) == {"do_sell", "not_sold", "popular", "decline", "margins", "sizes"}
    assert counts["popular"] == 200 and counts["not_sold"] > 0
    assert counts["sizes"] > 0 and counts["do_sell"] > 0
    # only the report week's days reach the daily tables
    days = {r["date"] for r in spark.read.parquet(paths["sizes"]).select("date").distinct().collect()}
    assert days <= {dt.date(2024, 1, 8) + dt.timedelta(days=i) for i in range(7)}
    run_weekly(_inputs(spark), run, out, account="ACCOUNT US", replace=True)
    again = {k: _count(spark, p) for k, p in paths.items()}
    assert again == counts
    # the dashboard views over the appended table, queried by name
    register_views(spark, out)
    monthly = spark.sql("SELECT ID, Monthum, YearNum, CTR FROM do_sell_by_month")
    assert monthly.count() > 0
    assert spark.sql("SELECT count(*) AS n FROM do_sell").first()["n"] == counts["do_sell"]


def test_replace_leaves_the_same_week_of_another_year(spark):
    out = FX.scratch_path(spark, "weekly-years")
    for run in (dt.date(2024, 1, 15), dt.date(2025, 1, 13), dt.date(2024, 1, 15)):
        paths = run_weekly(_inputs(spark), run, out, account="ACCOUNT US", replace=True)
    table = spark.read.parquet(paths["popular"])
    weeks = {r["report_monday"]: r["n"] for r in
             table.groupBy("report_monday").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert weeks == {dt.date(2024, 1, 8): 200, dt.date(2025, 1, 6): 200}
    assert dict(spark.read.parquet(paths["do_sell"]).dtypes)["yearNum"] == "string"


def test_reports_read_the_landed_days(spark):
    from shelfwise.plans.weekly import land_inputs, weekly_reports
    run = dt.date(2024, 1, 15)
    landed = land_inputs(_inputs(spark), run, FX.scratch_path(spark, "landed"))
    plain, from_landed = weekly_reports(_inputs(spark), run), weekly_reports(landed, run)
    for name, report in plain.items():
        plan = from_landed[name]._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan and "part.parquet" not in plan
        assert rows(report) == rows(from_landed[name])
