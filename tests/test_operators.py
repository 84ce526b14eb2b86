"""Operators and rewrites against literal / naive versions on small data."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfwise.operators import aggregates as A
from shelfwise.operators import filters as P
from shelfwise.operators import joins as J
from shelfwise.operators import ordering as O
from shelfwise.operators.currency import convert
from shelfwise.operators.windows import decline_rule
from shelfwise.plans import margin_report as K5_margins
from shelfwise.plans.popular_match import matched_products
from shelfwise.plans.views import do_sell_by_month, products_with_min_pop
from shelfwise.sources import analytics as AN
from shelfwise.sources import standins
from shelfwise.sources.popular import reported_gtin
from tests.conftest import rows

FEED_SCHEMA = "GID string, ID string, GTIN string, IMG string, BRAND string, Margin string, Size string"
ADS_M_SCHEMA = ("GID string, Account string, monthNum string, yearNum string, Impressions bigint, "
                "Clicks bigint, Cost bigint, ConversionValue double")


def test_gtin_prefix_join_literal_matches_empty_keys_clean_does_not(spark):
    left = spark.createDataFrame([("a", "12"), ("b", "100000000037"), ("c", None)], "GID string, GTIN string")
    rank = spark.createDataFrame([(1, "1234"), (2, "100000000037.0"), (3, "1000000000")],
                                 "Pop int, GTIN string")
    lit = rows(J.gtin_prefix_join(left, rank), "GID", "Pop")
    # '12' -> '' matches '1234' -> ''; the 12-digit code matches the '.0' twin
    assert lit == [("a", 1), ("b", 2)]
    clean = rows(J.gtin_prefix_join(left, rank, clean=True), "GID", "Pop")
    assert clean == [("b", 2)]


def _literal_matches(feed, ads_m, ranking):
    """The reference chain: J1 -> J2 -> A3 -> J3 -> A4 -> A5."""
    fx = feed.select(F.lower("GID").alias("GID"), "GTIN", "IMG", "BRAND")
    linking = J.feed_ads_join(fx, ads_m)
    pairs = A.distinct_rows(J.gtin_prefix_join(linking, ranking.select("Pop", "GTIN")), ["Pop", "GID"])
    return A.match_totals(A.dedup_matches(J.match_rows(linking, pairs)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matched_products_equals_literal_chain(spark, seed):
    rnd = random.Random(seed)
    feed = [(f"G{rnd.randint(0, 5)}", f"id{i}", str(100000 + rnd.randint(0, 40)), f"img{rnd.randint(0, 2)}",
             rnd.choice(["B1", "B2", None]), "10%", "9") for i in range(40)]
    ads = [(f"g{rnd.randint(0, 6)}", rnd.choice(["A", "B"]), rnd.choice(["01", "02"]), "2024",
            rnd.choice([1, 2]), rnd.choice([3, 4]), rnd.choice([0, 5]), rnd.choice([1.5, 2.5])) for _ in range(40)]
    ranking = [(i + 1, str(100000 + rnd.randint(0, 40)) + ".0") for i in range(15)]
    feed_df = spark.createDataFrame(feed, FEED_SCHEMA)
    ads_df = A.ads_totals(spark.createDataFrame(ads, ADS_M_SCHEMA),
                          ["GID", "Account", "monthNum", "yearNum"])
    rank_df = spark.createDataFrame(ranking, "Pop int, GTIN string")
    cols = ["GID", "IMG", "Pop", "monthNum", "yearNum", "Impressions", "Clicks", "Cost",
            "ConversionValue", "BRAND"]
    fast = matched_products(feed_df, ads_df, rank_df, n=15, one_account=False)
    assert rows(fast, *cols) == rows(_literal_matches(feed_df, ads_df, O.top_n(rank_df, 15)), *cols)


def test_one_account_shortcut_is_identity(spark):
    feed_df = spark.createDataFrame([("G1", "a", "100010", "i", "B", "0%", "1")], FEED_SCHEMA)
    ads_df = spark.createDataFrame([("g1", "A", "01", "2024", 2, 3, 4, 1.0)], ADS_M_SCHEMA)
    rank_df = spark.createDataFrame([(1, "100010.0")], "Pop int, GTIN string")
    a = matched_products(feed_df, ads_df, rank_df, n=1, one_account=True)
    b = matched_products(feed_df, ads_df, rank_df, n=1, one_account=False)
    assert rows(a, *sorted(a.columns)) == rows(b, *sorted(b.columns))


def _naive_decline(data, percent):
    out = []
    for key in sorted({r[0] for r in data}):
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        if len(group) == 4 and not (group[3][3] >= group[0][3] * percent):
            out += group
    return sorted(out)


@pytest.mark.parametrize("seed", [5, 6, 7, 8])
def test_decline_rule_equals_naive_loop(spark, seed):
    rnd = random.Random(seed)
    data = []
    for k in range(12):
        weeks = rnd.sample(range(1, 8), rnd.choice([3, 4, 4, 5]))
        for w in weeks:
            data.append((f"G{k}", w, f"n{rnd.randint(0, 1)}", round(rnd.uniform(0, 10), 2)))
    df = spark.createDataFrame(data, "ID string, weekNum int, productName string, newROAS double")
    got = rows(decline_rule(df, tie_break=("productName",)), "ID", "weekNum", "productName", "newROAS")
    assert got == _naive_decline(data, 0.5)


def test_decline_rule_requires_exactly_four_rows(spark):
    data = [("A", w, "n", v) for w, v in [(1, 10.0), (2, 9.0), (3, 8.0), (4, 1.0)]]
    data += [("B", w, "n", v) for w, v in [(1, 10.0), (2, 9.0), (3, 1.0)]]
    data += [("C", w, "n", v) for w, v in [(1, 10.0), (2, 9.0), (3, 8.0), (4, 6.0)]]
    df = spark.createDataFrame(data, "ID string, weekNum int, productName string, newROAS double")
    assert {r["ID"] for r in decline_rule(df, tie_break=("productName",)).collect()} == {"A"}


def test_margins_weighting_equals_literal_fan_out(spark):
    feed = spark.createDataFrame([
        ("G1", "x", "1", "i", "B1", "10%", "9"), ("G1", "y", "2", "i", "B2", "10%", "9"),
        ("G1", "z", "3", "i", "B2", "10%", "9"), ("G2", "w", "4", "i", None, "20%", "9"),
        ("G2", "v", "5", "i", "B3", "20%", "9")], FEED_SCHEMA)
    day = dt.date(2024, 1, 8)
    ads = spark.createDataFrame([(day, "g1 shoes", 2_000_000), (day, "g1", 1_000_000), (day, "g2", 0)],
                                "Date date, GID string, Cost bigint")
    upper = ads.withColumn("GID", F.upper("GID"))
    an = spark.createDataFrame([("20240108", "g1", 100, 1), ("20240108", "g1", 50, 2), ("20240108", "g2", 7, 3),
                                ("ga:date", "g1", 1, 1)],
                               "date string, productSku string, itemRevenue bigint, itemQuantity bigint")
    got = rows(K5_margins.margins(feed, ads, an), "date", "Margin", "ROAS", "salesVolume")
    # literal: G1 has 2 distinct (Margin, Brand) rows, 2 analytics rows, daily cost 3.0
    # revenue 2*(100+50) = 300, cost 2 rows * 2 variants * 3.0 = 12, quantity 2*(1+2) = 6
    # Two variants (NULL brand kept), cost 0 -> ROAS NULL, quantity 2*3 = 6
    assert got == [(day, "10%", 25.0, 6), (day, "20%", None, 6)]
    # ad GIDs are compared in their own case unless asked otherwise
    assert K5_margins.margins(feed, upper, an).count() == 0
    assert rows(K5_margins.margins(feed, upper, an, lower_ads_gid=True),
                "date", "Margin", "ROAS", "salesVolume") == got


def test_fill_missing_keeps_fraction_in_integer_columns(spark):
    df = spark.createDataFrame([(None, None), (1.5, 3)], "ROAS double, salesVolume bigint")
    got = rows(P.fill_missing(df, ["ROAS", "salesVolume"]))
    assert got == [(-0.01, -0.01), (1.5, 3.0)]


def test_drop_not_set_keeps_nulls(spark):
    df = spark.createDataFrame([("(not set)",), (None,), ("shoe",)], "productName string")
    assert rows(P.drop_not_set(df)) == [(None,), ("shoe",)]


def test_currency_uses_latest_rate(spark):
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), "USD", 2.0), (dt.date(2024, 2, 1), "USD", 1.25),
                                   (dt.date(2024, 2, 1), "GBP", 0.5), (dt.date(2023, 1, 1), "GBP", 9.0)],
                                  "rate_date date, currency string, per_eur double")
    df = spark.createDataFrame([(10.0,)], "x double")
    assert df.select(convert(F.col("x"), rates, "USD", "GBP").alias("y")).first()["y"] == pytest.approx(4.0)
    assert df.select(convert(F.col("x"), rates, "USD", "USD").alias("y")).first()["y"] == 10.0


def test_view_one_pass_equals_literal_cte(spark):
    cols = ("ID string, Impressions bigint, Cost bigint, Clicks bigint, ConversionValue double, IMG string, "
            "BRAND string, Pop int, itemRev bigint, buyToDetailRate double, productName string, country string, "
            "monthNum string, yearNum string, newCost double, newROAS double, WeekNumber string")
    data = [("a", 10, 1, 2, 1.0, "i", "B", 5, 3, 10.0, "n", "US", "01", "2024", 1.0, 3.0, "3"),
            ("a", 20, 1, 4, 1.0, "j", "B", 7, 3, 20.0, "n", "US", "02", "2024", 1.0, 3.0, "3"),
            ("b", 10, 1, 2, 1.0, "i", "B", None, 3, 10.0, "n", "US", "01", "2024", 1.0, 3.0, "3"),
            ("c", 0, 1, 0, 1.0, "i", "B", 9, 3, 10.0, "n", "US", "01", "2024", 1.0, 3.0, "3")]
    ds = spark.createDataFrame(data, cols)
    ids = {r["ID"] for r in do_sell_by_month(ds).collect()}
    literal_ids = {r["ID"] for r in products_with_min_pop(ds, "monthNum").collect()}
    assert ids == literal_ids == {"a", "c"}
    c_row = do_sell_by_month(ds).filter("ID = 'c'").first()
    assert c_row["CTR"] is None  # 0 / 0 is NULL, not an error


def test_top_n_and_union(spark):
    df = spark.createDataFrame([(3, "c"), (1, "b"), (1, "a"), (2, "z")], "Pop int, GTIN string")
    assert [tuple(r) for r in O.top_n(df, 3).collect()] == [(1, "a"), (1, "b"), (2, "z")]
    u = O.union_pulls([df.limit(1), df.select("GTIN", "Pop").limit(1)])
    assert u.columns == ["Pop", "GTIN"] and u.count() == 2
    with pytest.raises(AnalysisException):
        O.union_pulls([df, df.select("Pop")])
    assert O.union_pulls([df, df.select("Pop")], allow_missing=True).filter("GTIN IS NULL").count() == 4


def test_global_row_number_is_consistent_under_pruning(spark):
    # many rows and partitions, ties on the first key; project a subset so
    # column pruning reshapes the branches (the counts must still agree)
    data = [(i, (i * 7919) % 97 / 4.0, f"n{i}") for i in range(5000)]
    df = spark.createDataFrame(data, "k long, price double, name string").repartition(7)
    order = [F.col("price").desc(), F.col("k").asc()]
    got = {r["k"]: r["Pop"] for r in O.global_row_number(df, order, -F.floor("price"), "Pop")
           .select("k", "Pop").collect()}
    expected = sorted(data, key=lambda t: (-t[1], t[0]))
    assert got == {t[0]: i + 1 for i, t in enumerate(expected)}


def test_gtin_pairs_equals_join_then_distinct(spark):
    feed = spark.createDataFrame([("g1", "12"), ("g1", "13"), ("g2", "100000000037"), ("g3", "1000000000370"),
                                  ("g3", None)], "GID string, GTIN string")
    rank = spark.createDataFrame([(1, "1234"), (2, "100000000037.0"), (3, "99")], "Pop int, GTIN string")
    literal = A.distinct_rows(J.gtin_prefix_join(feed, rank), ["Pop", "GID"])
    for clean in (False, True):
        lit = A.distinct_rows(J.gtin_prefix_join(feed, rank, clean=clean), ["Pop", "GID"])
        assert rows(J.gtin_pairs(feed, rank, clean=clean)) == rows(lit)
    assert rows(J.gtin_pairs(feed, rank)) == rows(literal) == [(1, "g1"), (2, "g2"), (3, "g1")]


def test_top_n_fan_in_equals_plain(spark):
    data = [(i % 50, f"{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(data, "Pop int, GTIN string").repartition(9)
    plain = [tuple(r) for r in O.top_n(df, 120).collect()]
    assert [tuple(r) for r in O.top_n(df, 120, fan_in=4).collect()] == plain
    assert plain == sorted(data)[:120]


def test_sizes_null_offer_joins_empty_size_and_fills(spark):
    from shelfwise.plans.size_report import sizes
    day = dt.date(2024, 1, 8)
    ads = spark.createDataFrame([(day, None, 0), (day, "g1-10.5|us", 2_000_000), (day, "g1-10.5|uk", 2_000_000)],
                                "Date date, OfferID string, Cost bigint")
    an = spark.createDataFrame([("20240108", "g1", "(not set)", 40, 2, "Shoes"),
                                ("20240108", "g1", "US 10.5Wm", 100, 1, "Shoes"),
                                ("20240108", "g1", "US 10.5Wm", 50, 1, "Bags"),
                                ("ga:date", "g1", "US 10.5Wm", 1, 1, "Shoes")],
                               "date string, productSku string, size string, itemRevenue bigint, "
                               "itemQuantity bigint, productType string")
    got = rows(sizes(ads, an))
    # '' (no offer id / no digits) joins '' with zero cost -> ROAS filled; 10.5: 100 / (2 + 2)
    assert got == [(day, "", -0.01, 2.0), (day, "10.5", 25.0, 1.0)]


def test_decline_order_by_year_across_new_year(spark):
    # weeks 52, 53 of 2020 and 1, 2 of 2021: ordered by week only, week 1 comes first
    data = [("A", 52, "2020", 10.0), ("A", 53, "2020", 9.0), ("A", 1, "2021", 8.0), ("A", 2, "2021", 1.0)]
    df = spark.createDataFrame(data, "ID string, weekNum int, yearNum string, newROAS double")
    literal = decline_rule(df, tie_break=("yearNum",))
    by_year = decline_rule(df, order_by_year=True, tie_break=())
    assert literal.count() == 0          # first = week 1 (8.0), last = week 53 (9.0): not declining
    assert by_year.count() == 4          # first = 2020-52 (10.0), last = 2021-2 (1.0): declining


def test_currency_errors(spark):
    rates = spark.createDataFrame([(dt.date(2024, 1, 2), "USD", 1.1)], "rate_date date, currency string, per_eur double")
    df = spark.createDataFrame([(10.0,)], "x double")
    assert df.select(convert(F.col("x"), None, "USD", "USD").alias("y")).first()["y"] == 10.0
    with pytest.raises(ValueError, match="rates"):
        convert(F.col("x"), None, "USD", "GBP")
    with pytest.raises(Exception, match="no rate for currency GBP"):
        df.select(convert(F.col("x"), rates, "USD", "GBP").alias("y")).collect()


def test_margins_beyond_64_bits_equal_the_fan_out(spark):
    """A day with 1e12 micros of cost, a million rows and 100 brands."""
    n, brands, cost = 1_000_000, 100, 10 ** 12
    analytics = spark.range(n).select(F.lit("20240108").alias("date"), F.lit("g1").alias("productSku"),
                                      F.lit("n").alias("productName"), F.lit(10 ** 6).cast("long").alias("itemRevenue"),
                                      F.lit(2).cast("long").alias("itemQuantity"))
    feed = spark.createDataFrame([("g1", f"b{i}", "10%") for i in range(brands)], "GID string, BRAND string, Margin string")
    ads = spark.createDataFrame([(dt.date(2024, 1, 8), "g1", cost)], "Date date, GID string, Cost bigint")
    got = K5_margins.margins(feed, ads, analytics).collect()
    assert len(got) == 1 and got[0]["salesVolume"] == 2 * n * brands
    assert abs(got[0]["ROAS"] - (10 ** 6 * n * brands) / (cost / 1e6 * n * brands)) < 1e-9


def test_reported_gtin_follows_each_file(spark):
    rows_in = [("a", "0012"), ("a", None), ("a", "100000000037"), ("b", "0012"), ("b", "7"),
               ("c", "00x1"), ("c", None), ("d", None)]
    raw = spark.createDataFrame(rows_in, "file string, GTIN string")
    got = sorted(tuple(r) for r in reported_gtin(raw, "file").select("file", "GTIN").collect())
    assert got == [("a", "100000000037.0"), ("a", "12.0"), ("a", "nan"), ("b", "12"), ("b", "7"),
                   ("c", "00x1"), ("c", "nan"), ("d", "nan")]


def test_segment_report_equals_the_report_over_segment_hits(spark):
    hits = standins.hits(spark, "/root/testdata/sf0.001")
    direct = AN.product_report(AN.user_segment(hits))
    got = AN.segment_report(hits)
    assert {r["segment"] for r in got.select("segment").distinct().collect()} == {"United States"}
    assert rows(got.select(*direct.columns)) == rows(direct)


@pytest.mark.parametrize("ranges", [1, 2, 16, 300])
def test_equi_depth_rank(spark, ranges):
    """Half of the rows have one value, some none; positions and range sizes."""
    from shelfwise.operators import ordering as O
    df = spark.range(0, 4000, 1, 7).select(
        "id", F.when(F.col("id") % 2 == 0, 5.0).when(F.col("id") % 97 == 0, None)
        .when(F.col("id") % 5 == 0, -1.5).otherwise(F.col("id") % 613 / 3).alias("v"))
    got = {r["id"]: r["Pop"] for r in O.equi_depth_rank(df, F.col("v"), F.col("id") % 1000 * 10 + F.floor(F.col("id") / 1000),
                                                        ranges=ranges).collect()}
    order = sorted(df.collect(), key=lambda r: (r["v"] is None, r["v"] or 0.0, r["id"] % 1000 * 10 + r["id"] // 1000))
    assert got == {r["id"]: i for i, r in enumerate(order, 1)}
    if ranges == 16:
        rows_ = df.withColumns({"_value": F.col("v"), "_tie": F.col("id")})
        cuts = O._cuts(rows_.select("_value", "_tie"), ranges)
        sizes = [r["count"] for r in rows_.withColumn("r", F.when(F.col("v").isNull(), -1).otherwise(O._range_of(cuts)))
                 .groupBy("r").count().collect()]
        assert max(sizes) <= 2 * 4000 / ranges


def test_equi_depth_rank_of_nothing(spark):
    from shelfwise.operators import ordering as O
    df = spark.createDataFrame([], "v double, id long")
    assert O.equi_depth_rank(df, F.col("v"), F.col("id"), ranges=8).count() == 0
    assert O.equi_depth_rank(df, F.col("v"), F.col("id")).count() == 0
    one = spark.createDataFrame([(None, 3)], "v double, id long")
    assert [r["Pop"] for r in O.equi_depth_rank(one, F.col("v"), F.col("id"), ranges=8).collect()] == [1]


def test_salted_join_spreads_a_heavy_key(spark):
    """Half of the rows have one key: the same rows as a plain join, and no
    task has more than an eighth of them."""
    from shelfwise.operators.joins import heavy_keys, salted_join
    left = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "").when(F.col("id") % 50 == 1, None)
                                      .otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("key"))
    right = spark.createDataFrame([("", 1), ("", 2), ("k1", 3), ("k7", 4), (None, 5)], "key string, v int")
    assert list(heavy_keys(left, "key", 1 / 16)) == [""]
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(before, ("false", "-1", "32")):
            spark.conf.set(c, v)
        joined = salted_join(left, right, "key")
        assert joined.count() == left.join(right, "key").count() and joined.columns == ["key", "id", "v"]
        assert rows(joined.filter("id < 200")) == rows(left.join(right, "key").filter("id < 200"))
        parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(parts) <= sum(parts) / 8
        plain = [r["count"] for r in left.join(right, "key").groupBy(F.spark_partition_id()).count().collect()]
        assert max(plain) > sum(plain) / 2
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert rows(salted_join(left.filter("key is null"), right, "key")) == []


def test_view_states_merge_in_any_parts(spark):
    """States of single rows, of weeks and of all merge to the view; a product
    without any rank is left out, a null measure is not averaged."""
    import random

    from shelfwise.plans import views as V
    rng = random.Random(8)
    columns = ("report_monday string, ID string, Impressions long, Cost long, Clicks long, ConversionValue double, IMG string, "
               "BRAND string, Pop int, itemRev long, buyToDetailRate double, productName string, country string, monthNum string, "
               "yearNum string, newCost double, newROAS double, WeekNumber string")
    data = [(f"w{rng.randrange(4)}", f"p{rng.randrange(6)}", rng.randrange(9), 1, rng.randrange(9), rng.choice([None, 1.5, 2.5]),
             rng.choice(["i", "j", None]), rng.choice(["b", None]), None, 3, 40.0, "n", "c", f"0{rng.randrange(3)}", "2024", 0.5, 1.25,
             str(rng.randrange(5))) for _ in range(300)]
    data = [r[:8] + (None if r[1] == "p0" else rng.choice([None, 3, 7]),) + r[9:] for r in data]
    table = spark.createDataFrame(data, columns)
    for period, from_states, view in (("monthNum", V.do_sell_by_month_from_states, V.do_sell_by_month),
                                      ("WeekNumber", V.do_sell_by_week_from_states, V.do_sell_by_week)):
        expected = view(table)
        for also in ([], ["report_monday"], ["report_monday", "Pop"]):
            got = from_states(V.view_states(table, period, also))
            assert got.columns == expected.columns
            close = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(df)]
            assert close(got) == close(expected)
        assert got.filter("ID = 'p0'").count() == 0
