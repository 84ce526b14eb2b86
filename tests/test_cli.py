"""The command-line weekly run over raw files equals the job over DataFrames."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from shelfwise.__main__ import main
from shelfwise.plans.weekly import WeeklyInputs, weekly_reports
from shelfwise.sources import fixtures as FX
from shelfwise.sources import standins as S
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
RUN = dt.date(2024, 1, 15)
DIMS = ["date", "productName", "productSku", "country", "size", "productType"]
METRICS = ["itemRevenue", "buyToDetailRate", "itemQuantity"]


def _count(spark, path):
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def test_cli_weekly_run_from_raw_files(spark):
    feed, ranking, ads, analytics = (FX.scratch_path(spark, n) for n in ("feed", "ranking", "ads", "an"))
    FX.write_feed_xml(S.feed(spark, SF), feed)
    FX.write_ranking_csv(S.ranking_report(spark, SF), ranking)
    FX.write_ads_report(S.ads(spark, SF), ads)
    FX.write_analytics_responses(S.analytics(spark, SF), analytics, DIMS, METRICS)
    out = FX.scratch_path(spark, "cli-out")
    paths = main(["--feed", feed, "--ranking", ranking, "--ads", ads, "--analytics", analytics,
                  "--analytics-sizes", analytics, "--out", out, "--run-date", RUN.isoformat(),
                  "--account", "ACCOUNT US"])
    an = S.analytics(spark, SF)
    direct = weekly_reports(WeeklyInputs(S.feed(spark, SF), S.popular(spark, SF), S.ads(spark, SF), an, an),
                            RUN, account="ACCOUNT US")
    for name, df in direct.items():
        assert _count(spark, paths[name]) == df.count(), name
    got = rows(spark.read.parquet(paths["sizes"]).select("date", "size", "ROAS", "salesVolume"))
    exp = rows(direct["sizes"].select("date", "size", "ROAS", "salesVolume"))
    assert [(a, b) for a, b, *_ in got] == [(a, b) for a, b, *_ in exp]
    assert all(abs(g[2] - e[2]) < 1e-9 and g[3] == e[3] for g, e in zip(got, exp))


def test_cli_publishes_a_run_once(spark, tmp_path):
    """A broken feed item is put aside, and a repeated run changes nothing."""
    from shelfwise.plans import read_published
    feed, ranking, ads, analytics = (FX.scratch_path(spark, n) for n in ("feed", "ranking", "ads", "an"))
    FX.write_feed_xml(S.feed(spark, SF), feed)
    spark.createDataFrame([("<item><g:id>x</g:idd></item>",)], "v string").write.mode("append").text(f"{feed}")
    FX.write_ranking_csv(S.ranking_report(spark, SF), ranking)
    FX.write_ads_report(S.ads(spark, SF), ads)
    FX.write_analytics_responses(S.analytics(spark, SF), analytics, DIMS, METRICS)
    out, bad = FX.scratch_path(spark, "cli-run"), FX.scratch_path(spark, "cli-bad")
    given = ["--feed", feed, "--ranking", ranking, "--ads", ads, "--analytics", analytics, "--analytics-sizes", analytics,
             "--out", out, "--run-date", RUN.isoformat(), "--account", "ACCOUNT US", "--run-id", "a", "--bad-documents", bad]
    assert main(given) == {"run": "a", "new": True}
    assert read_published(spark, out, "popular").count() == 200
    assert [r["value"] for r in spark.read.json(f"{bad}-feed").collect()] == ["<item><g:id>x</g:idd></item>"]
    assert main(given)["new"] is False
    assert read_published(spark, out, "popular").count() == 200
    with pytest.raises(SystemExit):
        main([*given, "--replace"])


def test_cli_needs_rates_for_another_currency(capsys):
    from shelfwise.__main__ import parse_args
    given = ["--feed", "f", "--ranking", "r", "--ads", "a", "--analytics", "x", "--analytics-sizes", "x", "--out", "o"]
    with pytest.raises(SystemExit):
        parse_args([*given, "--to-currency", "GBP"])
    assert "--rates" in capsys.readouterr().err
    assert parse_args([*given, "--to-currency", "GBP", "--rates", "t.csv", "--gtin-clean"]).gtin_clean
