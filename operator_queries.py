"""

Each callable takes (spark, sf_dir), builds the stand-in report tables over
the driver's parquet files and applies one library operator (or the chain
up to it) over the whole tables.  ``oracles.OPERATORS`` holds the matching
DuckDB SQL.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from shelfwise.functions import dates as D
from shelfwise.functions import numbers as N
from shelfwise.functions import text as T
from shelfwise.operators import aggregates as A
from shelfwise.operators import filters as P
from shelfwise.operators import joins as J
from shelfwise.operators import ordering as O
from shelfwise.operators.currency import convert
from shelfwise.operators.windows import decline_rule
from shelfwise.plans import decline_report as K4
from shelfwise.plans import margin_report as K5
from shelfwise.plans import popular_match as K1
from shelfwise.plans import run_ledger as PUB
from shelfwise.plans import size_report as K6
from shelfwise.plans import views as K7
from shelfwise.plans.weekly import REPORT_MONDAY, for_week
from shelfwise.sources import ads as ADS
from shelfwise.sources import analytics as AN
from shelfwise.sources import fixtures as FX
from shelfwise.sources import sinks as SINK
from shelfwise.sources import standins as S
from shelfwise.sources.feed import read_feed
from shelfwise.sources.popular import cast_ranking, normalize_ranking, read_ranking, reported_gtin

US = "ACCOUNT US"
N_TOP = 2000
LIFT = 1e-9     # see ``rounded``; the same in the oracles
RUN_DATES = [S.DEFAULT_RUN_DATE + _dt.timedelta(weeks=n) for n in (-1, 0, 1, 2)]
DECLINE_DAYS = D.four_week_calendar(S.DECLINE_RUN_DATE)


def rounded(df: DataFrame, places: int = 6, lift: float = 0.0) -> DataFrame:
    """Round every floating column at the very end (comparison hygiene only).
    Means of money have exact ties in the place after the last, which the order
    of a sum would decide; ``lift`` moves them off the tie."""
    cols = {f.name: F.round(F.col(f.name) + lift if lift else F.col(f.name), places) for f in df.schema.fields
            if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(cols) if cols else df


def _feed_lower(spark, d):
    return S.feed(spark, d).select(F.lower("GID").alias("GID"), F.lower("ID").alias("ID"),
                                   "GTIN", "IMG", "BRAND")


def _linking(spark, d):
    return J.feed_ads_join(_feed_lower(spark, d), K1.monthly_ads(S.ads(spark, d), US))


def _ranking(spark, d):
    return O.top_n(S.popular_top(spark, d, N_TOP), N_TOP).select("Pop", "GTIN")


def _prefix_rows(spark, d):
    rows = J.gtin_prefix_join(_linking(spark, d), _ranking(spark, d))
    return rows.select("GID", "Impressions", "Cost", "Clicks", "ConversionValue", "IMG", "BRAND",
                       "monthNum", "yearNum", "Pop")


def _pairs(spark, d):
    return A.distinct_rows(_prefix_rows(spark, d), ["Pop", "GID"])


def _match_rows(spark, d):
    return J.match_rows(_linking(spark, d), _pairs(spark, d)).select(
        "GID", "Impressions", "Cost", "Clicks", "ConversionValue", "IMG", "BRAND", "monthNum",
        "yearNum", "Pop")


def _matched(spark, d):
    return K1.matched_products(S.feed(spark, d), K1.monthly_ads(S.ads(spark, d), US),
                               S.popular_top(spark, d, N_TOP), N_TOP, one_account=True)


def do_sell_of_week(spark, d, run_date):
    """K1 as the weekly job runs it: last week's ads (S4), the report week's
    analytics (F5) and the week's label."""
    return K1.do_sell(S.feed(spark, d), ADS.last_week(S.ads(spark, d), run_date),
                      D.report_days(S.analytics(spark, d), D.reporting_week(run_date)),
                      S.popular_top(spark, d, N_TOP), run_date, n=N_TOP, account=US)


def stored_do_sell(spark, d, with_week=False):
    """The do_sell table that the weekly runs of four Mondays appended.  It is
    written once per session and read by the views and the operators over it."""
    stored = spark.__dict__.setdefault("_shelfwise_tables", {})
    if d not in stored:
        path = FX.scratch_path(spark, "do-sell-table")
        for run_date in RUN_DATES:
            SINK.append_table(for_week(do_sell_of_week(spark, d, run_date), run_date), path,
                              partition_by=[REPORT_MONDAY])
        stored[d] = path
    table = spark.read.parquet(stored[d])
    return table if with_week else table.drop(REPORT_MONDAY)


def _ads_us(spark, d):
    return S.ads(spark, d).filter(F.col("Account") == US)


def _weekly_rows(spark, d):
    return K4.weekly_matches(_ads_us(spark, d), S.analytics(spark, d), DECLINE_DAYS)


# ------------------------------------------------------------------ S8-S11
def s8_product_report(spark, d):
    return rounded(AN.product_report(S.hits(spark, d)))


def s8_report_request(spark, d):
    """The request as it is sent: users of a country, their hits from one
    source, the segment named freely."""
    return rounded(AN.segment_report(S.hits(spark, d), where=AN.from_source(), name="US users, paid clicks"))


def s8_weekly_buyers(spark, d):
    """Distinct buyers per week from stored daily bitmaps only."""
    path = FX.scratch_path(spark, "daily-buyers")
    SINK.append_table(AN.daily_buyers(S.hits(spark, d)), path, partition_by=["date"])
    stored = spark.read.schema("date string, productName string, productSku string, country string, block long, "
                               "buyers binary").parquet(path)
    week = D.week_number(F.to_date("date", "yyyyMMdd")).alias("weekNum")
    return AN.buyers_over_days(stored, [week, "productSku", "country"])


def s9_size_report(spark, d):
    return rounded(AN.size_report(S.hits(spark, d)))


def s8_segment_report(spark, d):
    return rounded(AN.segment_report(S.hits(spark, d)))


def s9_segment_sizes(spark, d):
    return rounded(AN.segment_report(S.hits(spark, d), AN.SIZE_DIMENSIONS))


def s10_user_segment(spark, d):
    return rounded(AN.segment_report(S.hits(spark, d)).drop(AN.SEGMENT))


def s11_traffic_source(spark, d):
    return rounded(AN.product_report(AN.traffic_source(S.hits(spark, d))))


# ------------------------------------------------------------------ joins
def j1_feed_ads_join(spark, d):
    return rounded(_linking(spark, d))


def j2_gtin_prefix_join(spark, d):
    return rounded(_prefix_rows(spark, d))


def j2_heavy_key(spark, d):
    """Half of the feed has short codes, so all of it meets on the empty key."""
    short = F.col("GTIN").substr(-1, 1).cast("int") % 2 == 0
    feed = S.feed(spark, d).withColumn("GTIN", F.when(short, "7").otherwise(F.col("GTIN")))
    ranking = _ranking(spark, d).withColumn("GTIN", F.when(F.col("Pop") <= 3, "12").otherwise(F.col("GTIN")))
    return J.gtin_prefix_join(feed, ranking, heavy_share=1 / 16)


def j3_match_rows(spark, d):
    return rounded(_match_rows(spark, d))


def j4_products_analytics(spark, d):
    an = K1.monthly_analytics(S.analytics(spark, d))
    return rounded(J.lower_key_join(_matched(spark, d), an, "GID", "productSku",
                                    also=["monthNum", "yearNum"]))


def j5_weekly_join(spark, d):
    return rounded(_weekly_rows(spark, d))


def j6_busy_gids(spark, d):
    return rounded(K4.weekly_ads(_ads_us(spark, d), DECLINE_DAYS, 400))


def j7_analytics_feed(spark, d):
    return K5.analytics_feed_rows(S.analytics(spark, d), S.feed(spark, d))


def j8_margin_cost_join(spark, d):
    rows = K5.analytics_feed_rows(S.analytics(spark, d), S.feed(spark, d))
    return K5.with_daily_cost(rows, S.ads(spark, d), lower_ads_gid=True)


def j9_size_join(spark, d):
    return rounded(K6.size_rows(S.ads(spark, d), S.analytics(spark, d)))


def j10_min_pop_semi(spark, d):
    ds = stored_do_sell(spark, d)
    minima = A.first_min_pop(ds, "monthNum").select("Pop").distinct()
    return rounded(J.keep_keys(ds, minima, "Pop"))


def j11_view_x_join(spark, d):
    ds = stored_do_sell(spark, d)
    x = K7.products_with_min_pop(ds, "monthNum").select("ID")
    return rounded(J.keep_keys(ds, x, "ID"))


def j12_currency(spark, d):
    ads = S.ads(spark, d)
    return rounded(ads.select("Date", "GID", "OfferID", "Cost",
                              convert(N.micros_to_units("Cost"), S.rates(spark), "USD", "GBP").alias("newCost")))


# ------------------------------------------------------------ aggregations
def a1_monthly_ads(spark, d):
    return rounded(K1.monthly_ads(S.ads(spark, d), US))


def a2_monthly_analytics(spark, d):
    return rounded(K1.monthly_analytics(S.analytics(spark, d)))


def a3_distinct_pop_gid(spark, d):
    return _pairs(spark, d)


def a4_match_dedup(spark, d):
    return rounded(A.dedup_matches(_match_rows(spark, d)))


def a5_match_totals(spark, d):
    return rounded(_matched(spark, d))


def _ads_gid(spark, d):
    ads = S.ads(spark, d)
    return ads.select(T.before_first_space("GID").alias("GID"), "Account", "Date", "Impressions",
                      "Clicks", "Cost", "ConversionValue")


def a6_clicks_per_gid(spark, d):
    return A.clicks_per_gid(_ads_gid(spark, d))


def a7_weekly_ads(spark, d):
    ad = _ads_gid(spark, d).select("GID", "Account", D.week_number("Date").alias("weekNum"),
                                   D.year_str("Date").alias("yearNum"), *A.AD_METRICS)
    return rounded(A.ads_totals(ad, ["GID", "Account", "weekNum", "yearNum"]))


def a8_weekly_analytics(spark, d):
    return rounded(K4.weekly_analytics(S.analytics(spark, d), None))


def a9_daily_ad_cost(spark, d):
    return A.cost_totals(_ads_gid(spark, d), ["Date", "GID"])


def a10_distinct_margins(spark, d):
    return K5.margin_feed(S.feed(spark, d))


def a11_margin_roas(spark, d):
    return rounded(K5.margins(S.feed(spark, d), S.ads(spark, d), S.analytics(spark, d),
                              S.rates(spark), "USD", "GBP", lower_ads_gid=True))


def a12_size_analytics(spark, d):
    return K6.analytics_by_size(S.analytics(spark, d))


def a13_size_ad_cost(spark, d):
    return rounded(K6.ads_by_size(S.ads(spark, d)))


def a14_size_roas(spark, d):
    return rounded(K6.sizes(S.ads(spark, d), S.analytics(spark, d), S.rates(spark), "USD", "GBP"))


def a15_min_pop(spark, d):
    return A.first_min_pop(stored_do_sell(spark, d), "monthNum")


def a16_avg_pop_x(spark, d):
    return rounded(K7.products_with_min_pop(stored_do_sell(spark, d), "monthNum"), lift=LIFT)


def a17_view_rollup(spark, d):
    return rounded(A.view_rollup(stored_do_sell(spark, d), "monthNum", "Monthum", round_clicks=True), lift=LIFT)


# ------------------------------------------------- window, order, union
def w1_decline_rule(spark, d):
    priced = K4.price(P.drop_not_set(_weekly_rows(spark, d)))
    return rounded(decline_rule(priced, percent=0.75))


def o1_rank_order(spark, d):
    return rounded(O.by_rank(S.popular(spark, d)))


def o1_global_rank(spark, d):
    """Every part's place by whole price, a value that very many share, then
    key; in ranges cut by quantile sketches."""
    p = S.table(spark, d, "part").select("p_partkey", F.floor(F.col("p_retailprice") / 500).cast("int").alias("price"))
    return O.equi_depth_rank(p, -F.col("price"), F.col("p_partkey"), ranges=16)


def o2_top_n(spark, d):
    return rounded(O.top_n(S.popular(spark, d), N_TOP))


def o3_output_order(spark, d):
    return rounded(O.output_order(_weekly_rows(spark, d), ["ID", "weekNum"]))


def u1_union_pulls(spark, d):
    """The seven daily pulls as one read of the table that holds them all."""
    return D.report_days(S.analytics(spark, d), D.reporting_week(S.DEFAULT_RUN_DATE))


# ------------------------------------------------------------- filters
def p1_account_filter(spark, d):
    return rounded(P.account_filter(S.ads(spark, d), US))


def p2_not_in_inventory(spark, d):
    return rounded(P.not_in_inventory(S.popular(spark, d)))


def p3_country_filter(spark, d):
    return P.country_filter(S.analytics(spark, d))


def p4_category_filter(spark, d):
    return P.category_filter(S.analytics(spark, d))


def p5_having_clicks(spark, d):
    return P.having_clicks_over(A.clicks_per_gid(_ads_gid(spark, d)), 400)


def p6_integer_dates(spark, d):
    return P.integer_dates(S.analytics(spark, d))


def p7_drop_not_set(spark, d):
    return P.drop_not_set(S.analytics(spark, d))


def p8_drop_rename(spark, d):
    return rounded(normalize_ranking(S.ranking_report(spark, d), S.DEFAULT_RUN_DATE))


def p9_type_casts(spark, d):
    return rounded(cast_ranking(S.ranking_report(spark, d)).select("Popularity rank", "GTIN", "Title"))


def _dirty_ranking(spark, d):
    """Ranking codes as files may have them: file a with blank, short and
    zero-led codes, file b without the blank ones."""
    p = S.table(spark, d, "part").select("p_partkey")
    code = (F.lit(S.GTIN_BASE) + F.col("p_partkey") * S.GTIN_STEP).cast("string")
    last = F.col("p_partkey") % 10
    gtin = (F.when(last == 0, F.lit(None)).when(last == 1, F.lit("12")).when(last == 2, F.concat(F.lit("0"), code))
            .when(last == 3, F.concat(F.lit("00"), code)).otherwise(code))
    return p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "a").otherwise("b").alias("src"), gtin.alias("GTIN"))


def p9_gtin_forms(spark, d):
    return reported_gtin(_dirty_ranking(spark, d), "src")


def j2_gtin_forms(spark, d):
    ranking = reported_gtin(_dirty_ranking(spark, d), "src").select(F.col("p_partkey").alias("Pop"), "GTIN")
    feed = S.feed(spark, d).select(F.lower("GID").alias("GID"), "GTIN")
    pairs = [J.gtin_pairs(feed, ranking, clean=clean).withColumn("rule", F.lit(rule))
             for rule, clean in (("literal", False), ("clean", True))]
    return O.union_pulls(pairs)


def p10_labels(spark, d):
    return rounded(P.with_label(_weekly_rows(spark, d), "WeekRange", D.week_range_label(DECLINE_DAYS)))


def p11_fill_missing(spark, d):
    ads = S.ads(spark, d)
    per_offer = ads.groupBy("Date", "OfferID").agg(
        N.ratio(F.sum("ConversionValue"), N.micros_to_units(F.sum("Cost"))).alias("ROAS"),
        F.count(F.lit(1)).alias("salesVolume"))
    return rounded(P.fill_missing(per_offer, ["ROAS", "salesVolume"]))


def p12_ads_cost_projection(spark, d):
    return P.ads_cost_projection(S.ads(spark, d))


# ----------------------------------------------------------- scalar functions
def f1_month_str(spark, d):
    return S.ads(spark, d).select("Date", D.month_str("Date").alias("monthNum")).distinct()


def f2_year_str(spark, d):
    return S.ads(spark, d).select("Date", D.year_str("Date").alias("yearNum")).distinct()


def f3_week_number(spark, d):
    return S.ads(spark, d).select("Date", D.week_number("Date").alias("weekNum")).distinct()


def f4_compact_to_iso(spark, d):
    return S.analytics(spark, d).select("date", D.compact_to_iso("date").alias("iso")).distinct()


def f5_reporting_week(spark, d):
    days = [x.strftime("%Y%m%d") for x in D.reporting_week(S.DEFAULT_RUN_DATE)]
    an = S.analytics(spark, d).filter(F.col("date").isin(*days))
    return an.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def f6_four_week_calendar(spark, d):
    ads = S.ads(spark, d).filter(F.col("Date").between(F.lit(DECLINE_DAYS[0]), F.lit(DECLINE_DAYS[-1])))
    return ads.groupBy(D.week_number("Date").alias("weekNum")).agg(F.count(F.lit(1)).alias("n_rows"))


def f7_before_first_space(spark, d):
    return S.ads(spark, d).select("GID", T.before_first_space("GID").alias("gid_clean")).distinct()


def f8_lower_key(spark, d):
    return S.ads(spark, d).select(T.lower_key(T.before_first_space("GID")).alias("gid")).distinct()


def f9_offer_key(spark, d):
    return S.ads(spark, d).select("OfferID", T.offer_key("OfferID").alias("offer")).distinct()


def f10_last_dash_token(spark, d):
    return S.ads(spark, d).select(
        "OfferID", T.last_dash_token(T.offer_key("OfferID")).alias("token")).distinct()


def f11_clean_size(spark, d):
    return S.analytics(spark, d).select("size", T.clean_size("size").alias("clean")).distinct()


def f12_digits_and_dots(spark, d):
    return S.analytics(spark, d).select(
        "size", T.digits_and_dots(T.clean_size("size")).alias("digits")).distinct()


def f13_new_sku(spark, d):
    an = S.analytics(spark, d)
    return an.select("productSku", "size",
                     T.new_sku("productSku", T.clean_size("size")).alias("NEWSKU")).distinct()


def f14_gtin_key(spark, d):
    fd = S.feed(spark, d).select(F.lit("feed").alias("side"), "GTIN",
                                 N.gtin_key("GTIN", 2).alias("gtin_key"),
                                 N.gtin_key("GTIN", 2, clean=True).alias("clean_key"))
    rk = S.popular(spark, d).select(F.lit("ranking").alias("side"), "GTIN",
                                    N.gtin_key("GTIN", 4).alias("gtin_key"),
                                    N.gtin_key("GTIN", 2, clean=True).alias("clean_key"))
    return fd.unionByName(rk)


def f15_micros_to_units(spark, d):
    return rounded(S.ads(spark, d).select("Date", "OfferID", "Cost",
                                          N.micros_to_units("Cost").alias("units")))


def f16_roas(spark, d):
    ads = S.ads(spark, d)
    return rounded(ads.select("Date", "OfferID",
                              N.roas("ConversionValue", N.micros_to_units("Cost")).alias("newROAS")))


def f17_lenient_numbers(spark, d):
    an = S.analytics(spark, d)
    return rounded(an.select(
        "date", "productSku",
        N.lenient_double("size").alias("size_num"),
        N.lenient_double(T.clean_size("size")).alias("clean_num"),
        N.lenient_double(F.concat(F.col("itemRevenue").cast("string"), F.lit("x"))).alias("rev_num"),
        N.lenient_bigint(F.concat(F.col("buyToDetailRate").cast("string"), F.lit(".7"))).alias("btdr_int"),
        N.lenient_double("productName").alias("name_num")))


def f18_btdr(spark, d):
    an = S.analytics(spark, d)
    return rounded(an.select("buyToDetailRate", N.btdr("buyToDetailRate").alias("BTDR")).distinct())


# ------------------------------------------- S1-S7, S12, S13: file round trips

AN_DIMENSIONS = ["date", "productName", "productSku", "country", "size", "productType"]
AN_METRICS = ["itemRevenue", "buyToDetailRate", "itemQuantity"]
API_FIELDS = ["ga:date", "ga:productName", "ga:productSku", "ga:country", "ga:dimensionX",
              "ga:productCategoryLevelX", "ga:itemRevenue", "ga:buyToDetailRate", "ga:itemQuantity"]


def _feed_file(spark, d):
    path = FX.scratch_path(spark, "feed-xml")
    FX.write_feed_xml(S.feed(spark, d), path)
    return path


def s1_feed_xml(spark, d):
    return read_feed(spark, _feed_file(spark, d), shape="default")


def s1_feed_margins(spark, d):
    return read_feed(spark, _feed_file(spark, d), shape="margins")


def s1_feed_decline(spark, d):
    return read_feed(spark, _feed_file(spark, d), shape="decline")


def s1_feed_size(spark, d):
    return read_feed(spark, _feed_file(spark, d), shape="size")


def s2_ranking_csv(spark, d):
    path = FX.scratch_path(spark, "ranking-csv")
    FX.write_ranking_csv(S.ranking_report(spark, d), path)
    return rounded(read_ranking(spark, path, S.DEFAULT_RUN_DATE))


def s2_mixed_headers(spark, d):
    """Two ranking files in one folder: one with reversed columns, one without
    a column; read at once."""
    path, report = FX.scratch_path(spark, "ranking-mixed"), S.ranking_report(spark, d)
    odd = F.col("Popularity rank") % 2 == 1
    FX.write_ranking_csv(report.filter(odd).select(*report.columns[::-1]), f"{path}/a")
    FX.write_ranking_csv(report.filter(~odd).drop("Brand inventory status"), f"{path}/b")
    return rounded(read_ranking(spark, [f"{path}/a", f"{path}/b"], S.DEFAULT_RUN_DATE, gtin_text=True))


def s1_feed_bad_items(spark, d):
    """A feed in which every seventh item has a wrong end tag and every
    eleventh has none: all others are rows, these are diverted."""
    path = FX.scratch_path(spark, "feed-broken")
    p = S.table(spark, d, "part").select("p_partkey", "p_size")
    key, bad, open_ = F.col("p_partkey").cast("string"), F.col("p_partkey") % 7 == 0, F.col("p_partkey") % 11 == 0
    item = F.concat(F.lit("<item><g:item_group_id>g"), key, F.lit("</g:item_group_id><g:id>"), key,
                    F.when(bad, "</g:idd>").otherwise("</g:id>"), F.lit("<g:size>"), F.col("p_size").cast("string"),
                    F.when(open_, "</g:size>").otherwise("</g:size></item>"))
    p.select(item).write.text(f"{path}/feed")
    rows = read_feed(spark, f"{path}/feed", shape="size", divert_to=f"{path}/bad")
    diverted = spark.read.schema("value string").json(f"{path}/bad")
    return rows.select("ID", "Size", F.lit(False).alias("diverted")).unionByName(diverted.select(
        F.regexp_extract("value", "<g:id>([0-9]+)", 1).alias("ID"), F.lit(None).cast("string").alias("Size"),
        F.lit(True).alias("diverted")))


def s3_ads_csv(spark, d):
    path = FX.scratch_path(spark, "ads-csv")
    FX.write_ads_report(S.ads(spark, d), path)
    return rounded(ADS.read_ads(spark, path))


def s3_ads_mixed_headers(spark, d):
    """Two reports with other column orders in one folder, read at once."""
    path, ads = FX.scratch_path(spark, "ads-mixed"), S.ads(spark, d)
    FX.write_ads_report(ads.filter(F.col("Clicks") == 1), path)
    FX.write_ads_report(ads.filter(F.col("Clicks") != 1), path, header=ADS.REPORT_COLUMNS[::-1])
    return rounded(ADS.read_ads(spark, path))


def s4_last_week_ads(spark, d):
    return rounded(ADS.last_week(S.ads(spark, d), S.DEFAULT_RUN_DATE))


def s5_range_ads(spark, d):
    return rounded(ADS.date_range(S.ads(spark, d), DECLINE_DAYS[0], DECLINE_DAYS[-1]))


def _responses(spark, d):
    path = FX.scratch_path(spark, "analytics-json")
    FX.write_analytics_responses(S.analytics(spark, d), path, AN_DIMENSIONS, AN_METRICS)
    return AN.flatten_responses(AN.read_responses(spark, path), API_FIELDS)


def s6_analytics_json(spark, d):
    return _responses(spark, d)


def s6_analytics_variant(spark, d):
    """Responses stored with the columns that nobody listed as one VARIANT; a
    name unknown when they were read is taken from the stored table."""
    path, table = FX.scratch_path(spark, "analytics-json"), FX.scratch_path(spark, "analytics-variant")
    FX.write_analytics_responses(S.analytics(spark, d), path, AN_DIMENSIONS, AN_METRICS)
    flat = AN.flatten_responses(AN.read_responses(spark, path), ["ga:date", "ga:productSku"], others="others")
    SINK.append_table(flat, table)
    stored = spark.read.parquet(table)
    return stored.select("ga:date", "ga:productSku", *[
        AN.other_field(name).alias(name) for name in ("ga:country", "ga:itemRevenue", "ga:nothing")])


def s7_analytics_rename(spark, d):
    return AN.rename_fields(_responses(spark, d))


def s12_append_sink(spark, d):
    path = FX.scratch_path(spark, "sizes-table")
    report = K6.sizes(S.ads(spark, d), S.analytics(spark, d))
    SINK.append_table(report, path, partition_by=["date"])
    SINK.append_table(report, path, partition_by=["date"])  # a re-run appends again
    return rounded(spark.read.parquet(path))


def s12_run_ledger(spark, d):
    """Reports of two weeks published as runs: one run is repeated, one is
    superseded, one stops before its ledger entry.  Read back as published."""
    out = FX.scratch_path(spark, "published")
    week = lambda run: (ADS.last_week(S.ads(spark, d), run), D.report_days(S.analytics(spark, d), D.reporting_week(run)))
    for run in RUN_DATES[1:3]:
        monday = D.reporting_week(run)[0]
        sizes, margins = K6.sizes(*week(run)), K5.margins(S.feed(spark, d), *week(run), lower_ads_gid=True)
        if run == RUN_DATES[1]:
            PUB.publish({"sizes": sizes.limit(3), "margins": margins.limit(3)}, out, monday, "first-try")
        PUB.publish({"sizes": sizes, "margins": margins}, out, monday, "final")
        PUB.publish({"sizes": sizes.limit(0), "margins": margins}, out, monday, "final")      # there already
        stopped = sizes.withColumns({REPORT_MONDAY: F.lit(monday), PUB.RUN_ID: F.lit("stopped")})
        SINK.append_table(stopped, f"{out}/sizes", [REPORT_MONDAY, PUB.RUN_ID])
    return rounded(PUB.read_published(spark, out, "sizes"))


def u1_latest_pull(spark, d):
    """Three overlapping pulls of the ad report: two weeks, then a corrected
    one from the second week on; the third is older than both and comes last."""
    from shelfwise.streaming import ads_pulls, land_pulls, read_days
    landing, table = FX.scratch_path(spark, "pull-landing"), FX.scratch_path(spark, "pull-table")
    ckpt, ads = FX.scratch_path(spark, "pull-ckpt"), S.ads(spark, d)
    pulls = [("2024-01-15", ads.filter(F.col("Date") < "2024-01-15").withColumn("Clicks", F.lit(0).cast("long"))),
             ("2024-01-29", ads.filter(F.col("Date") >= "2024-01-08")),
             ("2024-01-02", ads.filter(F.col("Date") < "2024-01-10").withColumn("Cost", F.lit(0).cast("long")))]
    for pull, rows in pulls:
        FX.write_ads_report(rows, f"{landing}/pull={pull}")
        land_pulls(ads_pulls(spark, landing), table, ckpt)
    return rounded(read_days(spark, table).select("pull", "Date", "GID", "OfferID", "Account", "Impressions", "Clicks",
                                                  "Cost", "ConversionValue"))


def u1_stream_ingest(spark, d):
    """U1 + S12 incrementally: report files landed in a folder, ingested by
    an available-now Structured Streaming run, read back from the table."""
    from shelfwise.streaming import ads_report_stream, append_new_files
    landing = FX.scratch_path(spark, "ads-landing")
    FX.write_ads_report(S.ads(spark, d), landing)
    table, ckpt = FX.scratch_path(spark, "ads-table"), FX.scratch_path(spark, "ads-ckpt")
    append_new_files(ads_report_stream(spark, landing), table, ckpt)
    return rounded(spark.read.parquet(table).drop("ingest_stream", "ingest_batch"))


def s13_csv_dump(spark, d):
    path = FX.scratch_path(spark, "margins-csv")
    report = K5.margins(S.feed(spark, d), S.ads(spark, d), S.analytics(spark, d), lower_ads_gid=True)
    SINK.dump_csv(report, path)
    return rounded(spark.read.schema(report.schema).option("header", "true").csv(path))


def do_sell_by_month_states(spark, d):
    """K7 from stored states of four weeks, one of which was replaced."""
    path = FX.scratch_path(spark, "month-states")
    table = stored_do_sell(spark, d, with_week=True)
    replaced = D.reporting_week(RUN_DATES[2])[0]
    wrong = table.filter(F.col(REPORT_MONDAY) == F.lit(replaced)).withColumn("Clicks", F.col("Clicks") + 1000)
    K7.store_view_states(table.filter(F.col(REPORT_MONDAY) != F.lit(replaced)).unionByName(wrong), path, "monthNum")
    K7.store_view_states(table.filter(F.col(REPORT_MONDAY) == F.lit(replaced)), path, "monthNum")
    return rounded(K7.do_sell_by_month_from_states(spark.read.parquet(path)), lift=LIFT)


OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items()
    if callable(fn) and name[:1] in "sjawoupf" and name[1:2].isdigit()
} | {"do_sell_by_month_states": do_sell_by_month_states}
