"""Publishing all tables of a week as one run."""

import datetime as dt

import pytest

from shelfwise.plans import run_ledger as R
from shelfwise.plans.weekly import WeeklyInputs
from shelfwise.sources import fixtures as FX
from shelfwise.sources import sinks
from shelfwise.sources import standins as S
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
WEEK, NEXT = dt.date(2024, 1, 8), dt.date(2024, 1, 15)


def _reports(spark, n, names=("a", "b", "c")):
    return {t: spark.range(n).selectExpr("id", f"'{t}' AS t", "id / 3 AS x") for t in names}


def test_runs_are_seen_whole_and_once(spark, monkeypatch):
    out = FX.scratch_path(spark, "runs")
    assert R.publish(_reports(spark, 5), out, WEEK, "one")
    assert R.read_published(spark, out, "a").count() == 5
    assert not R.publish(_reports(spark, 9), out, WEEK, "one")          # a repeat does nothing
    assert R.read_published(spark, out, "a").count() == 5

    written = []

    def stops(df, path, *args, **kwargs):
        if len(written) == 2:
            raise RuntimeError("lost")
        written.append(path)
        sinks.append_table(df, path, *args, **kwargs)

    monkeypatch.setattr(R, "append_table", stops)
    with pytest.raises(RuntimeError):
        R.publish(_reports(spark, 7), out, WEEK, "two")                 # stops after two of three tables
    monkeypatch.undo()
    assert len(written) == 2
    assert all(R.read_published(spark, out, t).count() == 5 for t in "abc")
    assert R.publish(_reports(spark, 7), out, WEEK, "two")              # tried again: its folders are replaced
    assert all(R.read_published(spark, out, t).count() == 7 for t in "abc")
    assert R.publish(_reports(spark, 2), out, NEXT, "two")              # another week
    assert rows(R.read_published(spark, out, "c").groupBy("report_monday").count()) == [(WEEK, 7), (NEXT, 2)]
    assert rows(R.superseded(spark, out)) == [(WEEK, "one")]


def test_entry_of_part_of_the_tables_is_no_run(spark):
    out = FX.scratch_path(spark, "runs")
    R.publish(_reports(spark, 3), out, WEEK, "one")
    R.publish(_reports(spark, 4), out, WEEK, "two")
    part = R.ledger(spark, out).filter("run_id = 'two' AND table_name <> 'b'").withColumnRenamed("x", "x")
    odd = part.selectExpr("report_monday", "'three' AS run_id", "table_name", "tables", "row_count", "checksum", "columns",
                          "published_at + INTERVAL 1 DAY AS published_at")
    odd.write.mode("append").parquet(f"{out}/{R.LEDGER}")
    assert rows(R.current_runs(spark, out)) == [(WEEK, "two")]


def test_stored_rows_are_checked(spark):
    out = FX.scratch_path(spark, "runs")
    R.publish({**_reports(spark, 3), "empty": spark.range(0)}, out, WEEK, "one")
    assert R.check_run(spark, out, WEEK, "one") == []
    assert R.read_published(spark, out, "empty").count() == 0
    assert R.read_published(spark, out, "empty").columns == ["id", "report_monday"]
    _reports(spark, 1)["b"].write.mode("append").parquet(f"{out}/b/report_monday={WEEK}/run_id=one")
    assert R.check_run(spark, out, WEEK, "one") == ["b"]
    entry = {r["table_name"]: (r["row_count"], r["tables"]) for r in R.ledger(spark, out).collect()}
    assert entry == {"a": (3, 4), "b": (3, 4), "c": (3, 4), "empty": (0, 4)}


def test_bad_names_and_unknown_tables(spark):
    out = FX.scratch_path(spark, "runs")
    with pytest.raises(ValueError, match="run id"):
        R.publish(_reports(spark, 1), out, WEEK, "a/b")
    with pytest.raises(ValueError, match="no published run"):
        R.read_published(spark, out, "a")


def test_weekly_job_as_a_run(spark):
    an = S.analytics(spark, SF)
    inputs = WeeklyInputs(feed=S.feed(spark, SF), ranking=S.popular(spark, SF), ads=S.ads(spark, SF), analytics=an, analytics_sizes=an)
    out = FX.scratch_path(spark, "weekly-run")
    assert R.publish_weekly(inputs, dt.date(2024, 1, 15), out, account="ACCOUNT US")
    assert not R.publish_weekly(inputs, dt.date(2024, 1, 15), out, account="ACCOUNT US")
    assert {r["table_name"] for r in R.ledger(spark, out).collect()} == {
        "do_sell", "not_sold", "popular", "decline", "margins", "sizes"}
    assert R.read_published(spark, out, "popular").count() == 200
    R.register_published_views(spark, out)
    assert spark.sql("SELECT * FROM do_sell_by_month").count() > 0
    plan = R.read_published(spark, out, "sizes")._jdf.queryExecution().executedPlan().toString()
    assert "run_id" in plan[plan.index("PartitionFilters"):]
