"""Scalar expressions F1-F18 and the calendar rules."""

import datetime as dt
import sqlite3

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.functions import numbers as N
from shelfwise.functions import text as T


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


def many(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {dtype}")
    return [r["out"] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_week_number_matches_strftime_w_plus_one_for_forty_years(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1995-01-01', DATE'2034-12-31')) AS d")
    got = {r["d"]: r["w"] for r in days.select("d", D.week_number("d").alias("w")).collect()}
    assert len(got) == 14610
    bad = [d for d, w in got.items() if w != int(d.strftime("%W")) + 1]
    assert bad == []


def test_week_number_around_new_year(spark):
    vals = many(spark, D.week_number(F.col("s")), [dt.date(2020, 12, 31), dt.date(2021, 1, 1),
                                                   dt.date(2024, 1, 1)], "date")
    assert vals == [53, 1, 2]


def test_month_and_year_text(spark):
    assert one(spark, D.month_str("s"), dt.date(2020, 5, 3), "s date") == "05"
    assert one(spark, D.year_str("s"), dt.date(2020, 5, 3), "s date") == "2020"


def test_compact_dates(spark):
    assert one(spark, D.compact_to_iso("s"), "20240131") == "2024-01-31"
    assert one(spark, D.compact_to_date("s"), "20240131") == dt.date(2024, 1, 31)
    assert one(spark, D.compact_to_date("s"), "ga:date") is None


def test_integer_dates_drop_headers_and_nulls(spark):
    vals = many(spark, D.is_integer_text("s"), ["20240101", " 20240101 ", "-5", "ga:date", "2024.1", None, ""])
    assert vals == [True, True, True, False, False, False, False]


@pytest.mark.parametrize("run, lags", [
    (dt.date(2024, 1, 15), [7, 6, 5, 4, 3, 2, 1]),      # Monday
    (dt.date(2024, 1, 17), [9, 1, 0, 6, 5, 4, 3]),      # Wednesday
    (dt.date(2024, 1, 21), [13, 5, 4, 3, 2, 1, 0]),     # Sunday
])
def test_reporting_week_day_lags(run, lags):
    assert [(run - d).days for d in D.reporting_week(run)] == lags


def test_reporting_week_snap_gives_previous_calendar_week():
    for offset in range(7):
        run = dt.date(2024, 1, 15) + dt.timedelta(days=offset)
        assert D.reporting_week(run, snap=True) == [dt.date(2024, 1, 8) + dt.timedelta(days=i) for i in range(7)]


def test_four_week_calendar_and_labels():
    days = D.four_week_calendar(dt.date(2024, 1, 29))
    assert days == [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(28)]
    assert D.week_range_label(days) == "2 - 5  -  2024-01-01 - 2024-01-28"
    assert D.week_label(dt.date(2024, 1, 15)) == "3"


def test_text_keys(spark):
    assert many(spark, T.before_first_space("s"), ["G12 shoes", "G12", "", " lead", None]) == \
        ["G12", "G12", "", "", None]
    assert many(spark, T.offer_key("s"), ["G1-3.5|US", "ABC", None]) == ["g1-3.5", "abc", "nan"]
    assert many(spark, T.last_dash_token("s"), ["g1-3.5", "a-b-c", "none"]) == ["3.5", "c", "none"]
    assert many(spark, T.new_sku(F.lit("G12"), F.col("s")), ["10.5W"]) == ["g12-10.5w"]


def test_size_cleanup(spark):
    clean = many(spark, T.clean_size("s"), ["US 10.5Wm", "UK 9", "(not set)", "US10"])
    assert clean == ["10.5W", "9", "(notset)", "10"]
    digits = many(spark, T.digits_and_dots(T.clean_size("s")), ["US 10.5Wm", "UK 9", "(not set)", "١٢.5"])
    assert digits == ["10.5", "9", "", "١٢.5"]


# SQLite SUBSTR(x, 0, LENGTH(x) - k) keeps LENGTH(x) - k - 1 characters.
GTINS = ["", "1", "12", "123", "1234", None, "0012345678905", "12345678905.0", "100000000037"]


def _sqlite_prefix(value, minus):
    con = sqlite3.connect(":memory:")
    return con.execute("SELECT SUBSTR(?, 0, LENGTH(?) - ?)", (value, value, minus)).fetchone()[0]


def test_gtin_key_matches_sqlite_substr_start_zero(spark):
    feed = many(spark, N.gtin_key("s", 2), GTINS)
    ranking = many(spark, N.gtin_key("s", 4), GTINS)
    assert feed == [_sqlite_prefix(g, 1) for g in GTINS]
    assert ranking == [_sqlite_prefix(g, 3) for g in GTINS]


def test_gtin_key_clean_mode(spark):
    assert many(spark, N.gtin_key("s", 2, clean=True), ["12345678905.0", "12345678905", "12", None]) == \
        ["123456789", "123456789", None, None]


# T5: SQLite casts text by its numeric prefix.
TEXTS = ["abc", "1.5x", "12.7", " 3", "-2.5e1x", "", "7", ".5", None]


def test_lenient_casts_match_sqlite(spark):
    con = sqlite3.connect(":memory:")
    real = [con.execute("SELECT CAST(? AS REAL)", (t,)).fetchone()[0] for t in TEXTS]
    integer = [con.execute("SELECT CAST(? AS INTEGER)", (t,)).fetchone()[0] for t in TEXTS]
    assert many(spark, N.lenient_double("s"), TEXTS) == real
    assert many(spark, N.lenient_bigint("s"), TEXTS) == integer


def test_money_and_ratios(spark):
    assert one(spark, N.micros_to_units("s"), 12_340_000, "s bigint") == pytest.approx(12.34)
    df = spark.createDataFrame([(10.0, 0.0), (10.0, -1.0), (10.0, 4.0), (10.0, None)], "r double, c double")
    got = [r["x"] for r in df.select(N.roas("r", "c").alias("x")).collect()]
    assert got == [0.0, 0.0, 2.5, None]
    got = [r["x"] for r in df.select(N.ratio("r", "c").alias("x")).collect()]
    assert got == [None, -10.0, 2.5, None]
    assert one(spark, N.btdr("s"), 25, "s bigint") == 0.25


def _random_texts(seed, n=300):
    import random
    rnd = random.Random(seed)
    alphabet = "0123456789.+-eE xa,"
    out = []
    for _ in range(n):
        out.append("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))))
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_lenient_casts_match_sqlite_on_random_text(spark, seed):
    texts = _random_texts(seed)
    con = sqlite3.connect(":memory:")
    real = [con.execute("SELECT CAST(? AS REAL)", (t,)).fetchone()[0] for t in texts]
    integer = [con.execute("SELECT CAST(? AS INTEGER)", (t,)).fetchone()[0] for t in texts]
    got_real = many(spark, N.lenient_double("s"), texts)
    got_int = many(spark, N.lenient_bigint("s"), texts)
    bad = [(t, g, e) for t, g, e in zip(texts, got_real, real) if g != pytest.approx(e)]
    assert bad == []
    assert [(t, g) for t, g, e in zip(texts, got_int, integer) if g != e] == []


@pytest.mark.parametrize("seed", [21])
def test_gtin_key_matches_sqlite_on_random_codes(spark, seed):
    import random
    rnd = random.Random(seed)
    codes = ["".join(rnd.choice("0123456789.") for _ in range(rnd.randint(0, 16))) for _ in range(300)]
    assert many(spark, N.gtin_key("s", 2), codes) == [_sqlite_prefix(c, 1) for c in codes]
    assert many(spark, N.gtin_key("s", 4), codes) == [_sqlite_prefix(c, 3) for c in codes]
