"""Plan-level guards over every registered query: no cross joins, no Python
UDF evaluation, and scans of the stand-in tables prune their columns."""

import re

import pytest

import __spark_entry__ as entry
from shelfwise.functions.dates import four_week_calendar
from shelfwise.plans.views import do_sell_by_week
from shelfwise.session import ensure_checkpoint_dir, scale_settings

SF_DIR = "/root/testdata/sf0.001"
# the training-data operators have plan tests of their own
QUERIES = {k: v for k, v in entry.queries().items() if not re.match(r"op\d|pipeline$", k)}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python_udf(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize("name", ["sizes", "margins", "do_sell", "decline"])
def test_event_scans_are_pruned(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line or "events.parquet" in line]
    assert schemas and all("props" not in s for s in schemas)


def test_scale_settings_bounds():
    big = scale_settings(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 51200
    assert int(scale_settings(100 * 2**50, 8000)["spark.sql.shuffle.partitions"]) == 65536
    assert int(scale_settings(2**20, 8)["spark.sql.shuffle.partitions"]) == 24
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_dir_is_set(spark):
    assert ensure_checkpoint_dir(spark)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_pulls_are_one_scan(spark):
    assert _plan(QUERIES["u1_union_pulls"](spark, SF_DIR)).count("FileScan") == 1


def test_decline_prunes_landed_analytics_by_day(spark, tmp_path):
    from shelfwise.plans.decline_report import weekly_analytics
    from shelfwise.sources import standins as S
    S.analytics(spark, SF_DIR).write.partitionBy("date").parquet(f"{tmp_path}/an")
    schema = S.analytics(spark, SF_DIR).schema
    landed = spark.read.schema(schema).parquet(f"{tmp_path}/an")
    plan = _plan(weekly_analytics(landed, four_week_calendar(S.DECLINE_RUN_DATE)))
    filters = plan[plan.index("PartitionFilters"):]
    assert "20240101" in filters[:filters.index("PushedFilters")]


def test_views_combine_before_the_first_exchange(spark):
    rows = [("one" if i % 2 else f"p{i}", 10, 5, 3, 1.0, "i", "b", 1, 7, 1.0, "n", "c", "01", "2024", 0.5, 1.4, str(i % 4))
            for i in range(400)]
    columns = ("ID string, Impressions long, Cost long, Clicks long, ConversionValue double, IMG string, BRAND string, "
               "Pop int, itemRev long, buyToDetailRate double, productName string, country string, monthNum string, "
               "yearNum string, newCost double, newROAS double, WeekNumber string")
    view = do_sell_by_week(spark.createDataFrame(rows, columns))
    lines = [line for line in _plan(view).splitlines() if "Exchange" in line or "Aggregate" in line]
    deepest = lines[-2:]
    assert "Exchange" in deepest[0] and "partial_" in deepest[1]
    assert view.filter("ID = 'one'").count() == 2


@pytest.mark.parametrize("name", ["do_sell_by_week", "j10_min_pop_semi", "j11_view_x_join"])
def test_stored_table_is_scanned_once_per_reference(spark, name):
    most = {"do_sell_by_week": 1, "j10_min_pop_semi": 2, "j11_view_x_join": 3}[name]
    assert _plan(QUERIES[name](spark, SF_DIR)).count("FileScan") <= most


@pytest.mark.parametrize("name", ["s8_report_request", "s8_segment_report", "s9_segment_sizes", "s10_user_segment"])
def test_segment_reports_scan_the_hits_once(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_writes_are_rebalanced_by_partition(spark):
    from shelfwise.sources.sinks import rebalanced
    plan = _plan(rebalanced(spark.range(10).selectExpr("id", "id % 3 AS day"), ["day"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_merged_reports_read_stored_rows_only(spark):
    """Buyers come from the bitmaps, the view from its states."""
    for name, column in (("s8_weekly_buyers", "buyers"), ("do_sell_by_month_states", "Clicks_sum")):
        plan = _plan(QUERIES[name](spark, SF_DIR))
        assert plan.count("FileScan") == 1 and column in plan and "events.parquet" not in plan


def test_top_of_the_ranking_is_numbered_after_the_cut(spark):
    plan = _plan(QUERIES["popular"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "TakeOrderedAndProject" in plan and "hashpartitioning" not in plan
