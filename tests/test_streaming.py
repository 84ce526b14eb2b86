"""Available-now ingestion: each run appends only files it has not seen."""

import datetime as dt

from shelfwise.sources import fixtures as FX
from shelfwise.streaming import ads_report_stream, append_new_files

HEADER = "Day,Item Id,Product type (1st level),Impressions,Clicks,Cost,Account,Total conv. value\n"


def _report(day, n):
    lines = [f"{day},g{i}-9.5|us,g{i} shoes,10,1,{i * 1000},ACCOUNT US,1.5" for i in range(n)]
    return "Shopping - Product Titles - 7 days\n" + HEADER + "\n".join(lines) + "\n"


def test_weekly_runs_append_only_new_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "w1.csv").write_text(_report("2024-01-08", 3))
    (landing / "w2.csv").write_text(_report("2024-01-15", 2))
    table = FX.scratch_path(spark, "stream-table")
    checkpoint = FX.scratch_path(spark, "stream-checkpoint")

    append_new_files(ads_report_stream(spark, str(landing)), table, checkpoint)
    first = spark.read.parquet(table)
    assert first.count() == 5
    assert {r["Date"] for r in first.select("Date").distinct().collect()} == {dt.date(2024, 1, 8),
                                                                              dt.date(2024, 1, 15)}

    (landing / "w3.csv").write_text(_report("2024-01-22", 4))
    append_new_files(ads_report_stream(spark, str(landing)), table, checkpoint)
    assert spark.read.parquet(table).count() == 9

    append_new_files(ads_report_stream(spark, str(landing)), table, checkpoint)   # nothing new
    assert spark.read.parquet(table).count() == 9


def test_two_streams_and_a_renewed_checkpoint_keep_all_rows(spark, tmp_path):
    table = FX.scratch_path(spark, "stream-table")
    for name, day, n in (("one", "2024-01-08", 3), ("two", "2024-01-15", 2)):
        landing = tmp_path / name
        landing.mkdir()
        (landing / "w.csv").write_text(_report(day, n))
        append_new_files(ads_report_stream(spark, str(landing)), table, FX.scratch_path(spark, "ckpt"))
    assert spark.read.parquet(table).count() == 5
    append_new_files(ads_report_stream(spark, str(tmp_path / "one")), table, FX.scratch_path(spark, "ckpt"))
    assert spark.read.parquet(table).count() == 8        # a fresh stream appends all it sees, and deletes nothing


def _pull(landing, pull, days, clicks, name="r.csv"):
    folder = landing / f"pull={pull}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{d},o{i},g{i},10,{clicks},1000,ACCOUNT US,1.5" for d in days for i in range(2)]
    (folder / name).write_text("title\n" + HEADER + "\n".join(lines) + "\n")


def _days(spark, table):
    from shelfwise.streaming import read_days
    return sorted((str(r["Date"]), r["pull"], r["Clicks"], r["n"]) for r in
                  read_days(spark, table).groupBy("Date", "pull", "Clicks").count().withColumnRenamed("count", "n").collect())


def test_newest_pull_of_a_day_counts(spark, tmp_path):
    from shelfwise.streaming import ads_pulls, land_pulls
    landing, table = tmp_path / "landing", FX.scratch_path(spark, "pulls")
    checkpoint = FX.scratch_path(spark, "pulls-ckpt")
    run = lambda ckpt=checkpoint: land_pulls(ads_pulls(spark, str(landing)), table, ckpt)
    d = ["2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11"]
    _pull(landing, "2024-01-15", d[:3], 1)
    run()
    assert _days(spark, table) == [(x, "2024-01-15", 1, 2) for x in d[:3]]
    _pull(landing, "2024-01-22", d[1:], 2)                  # overlaps two days
    run()
    newest = [(d[0], "2024-01-15", 1, 2)] + [(x, "2024-01-22", 2, 2) for x in d[1:]]
    assert _days(spark, table) == newest
    _pull(landing, "2024-01-10", d[:2], 7)                  # older, comes late
    run()
    assert _days(spark, table) == newest
    run()                                                   # nothing new
    run(FX.scratch_path(spark, "pulls-ckpt-2"))             # a fresh checkpoint replays every file as another stream ...
    assert _days(spark, table) == newest                    # ... and each counts once
    _pull(landing, "2024-01-22", d[3:], 3, "second.csv")    # one pull in two files
    run()
    assert (d[3], "2024-01-22", 3, 2) in _days(spark, table)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    """A batch whose commit was lost runs again with its number."""
    import glob
    import os

    from shelfwise.streaming import ads_pulls, land_pulls
    landing, table = tmp_path / "landing", FX.scratch_path(spark, "pulls")
    checkpoint = str(tmp_path / "ckpt")
    for pull, clicks in (("2024-01-15", 1), ("2024-01-22", 2)):
        _pull(landing, pull, ["2024-01-08", "2024-01-09"], clicks)
        land_pulls(ads_pulls(spark, str(landing)), table, checkpoint)
    before = _days(spark, table)
    for name in glob.glob(f"{checkpoint}/commits/*1") + glob.glob(f"{checkpoint}/commits/.1*"):
        os.remove(name)
    land_pulls(ads_pulls(spark, str(landing)), table, checkpoint)
    assert _days(spark, table) == before == [(x, "2024-01-22", 2, 2) for x in ("2024-01-08", "2024-01-09")]


def test_file_without_a_pull_is_an_error(spark, tmp_path):
    import pytest

    from shelfwise.streaming import ads_pulls, land_pulls
    (tmp_path / "landing" / "odd").mkdir(parents=True)
    (tmp_path / "landing" / "odd" / "r.csv").write_text(_report("2024-01-08", 1))
    with pytest.raises(Exception, match="no pull in the path"):
        land_pulls(ads_pulls(spark, str(tmp_path / "landing")), FX.scratch_path(spark, "pulls"), FX.scratch_path(spark, "c"))


def test_analytics_pulls(spark, tmp_path):
    import json

    from shelfwise.streaming import analytics_pulls, land_pulls, read_days
    for pull, revenue in (("1", "5"), ("2", "6")):
        folder = tmp_path / f"pull={pull}"
        folder.mkdir()
        header = {"dimensions": ["ga:date"], "metricHeader": {"metricHeaderEntries": [{"name": "ga:itemRevenue"}]}}
        (folder / "d.json").write_text(json.dumps({"reports": [{"columnHeader": header, "data": {
            "rows": [{"dimensions": ["20240108"], "metrics": [{"values": [revenue]}]}]}}]}))
    table = FX.scratch_path(spark, "an-pulls")
    land_pulls(analytics_pulls(spark, str(tmp_path), ["ga:date", "ga:itemRevenue"]), table, FX.scratch_path(spark, "c"), day="date")
    assert [(r["pull"], r["itemRevenue"]) for r in read_days(spark, table).collect()] == [("2", "6")]
