"""Readers and sinks on hand-made fixture files (FIXTURES.md section 1)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import ads as ADS
from shelfwise.sources import analytics as AN
from shelfwise.sources import fixtures as FX
from shelfwise.sources import sinks as SINK
from shelfwise.sources.feed import read_feed
from shelfwise.sources.popular import read_ranking
from tests.conftest import rows

FEED = """<?xml version="1.0"?>
<rss xmlns:g="http://base.google.com/ns/1.0" version="2.0">
<channel>
<title>Shop</title>
<item>
  <g:id>SKU1-10</g:id><g:item_group_id>SKU1 text</g:item_group_id><g:gtin>00012345678905</g:gtin>
  <g:image_link>http://x/1.jpg</g:image_link><g:brand>Acme &amp; Co</g:brand>
  <g:custom_label_0>20%</g:custom_label_0><g:size>US 10.5Wm</g:size>
</item>
<item>
  <g:id>sku1-11</g:id><g:item_group_id>sku1</g:item_group_id><g:gtin>12</g:gtin>
  <g:image_link>http://x/2.jpg</g:image_link><g:brand>Acme</g:brand><g:custom_label_0>20%</g:custom_label_0>
</item>
<item>
  <g:id>SKU2-9</g:id><g:item_group_id>SKU2</g:item_group_id>
  <g:brand>Other</g:brand><g:custom_label_0>0%</g:custom_label_0><g:size>UK 9</g:size>
</item>
</channel>
</rss>
"""


def test_feed_shapes_keep_text_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "feed.xml"
    path.write_text(FEED)
    default = rows(read_feed(spark, str(path), margin_field="g:custom_label_0"))
    assert default == [("SKU1 text", "SKU1-10", "00012345678905", "http://x/1.jpg", "Acme & Co"),
                       ("SKU2", "SKU2-9", None, None, "Other"),
                       ("sku1", "sku1-11", "12", "http://x/2.jpg", "Acme")]
    margins = rows(read_feed(spark, str(path), "margins", margin_field="g:custom_label_0"))
    assert margins[0] == ("0%", "SKU2", "Other")
    assert rows(read_feed(spark, str(path), "size")) == [
        (None, "sku1-11"), ("UK 9", "SKU2-9"), ("US 10.5Wm", "SKU1-10")]
    assert read_feed(spark, str(path), "decline").columns == ["GID", "IMG", "Brand"]


def test_feed_writer_round_trip(spark):
    df = spark.createDataFrame([("g1", "G1-9", "0012", "img/1", "A & <B>", "10%", "9"),
                                ("g2", "G2-1", None, "img/2", "C", "0%", "1")],
                               "GID string, ID string, GTIN string, IMG string, BRAND string, Margin string, Size string")
    path = FX.scratch_path(spark, "test-feed")
    FX.write_feed_xml(df, path)
    back = read_feed(spark, path)
    assert rows(back) == rows(df.select("GID", "ID", "GTIN", "IMG", "BRAND"))


RANKING = ('Popularity rank,Change from last week,Title,GTIN,Brand,Brand inventory status,'
           'Product inventory status,Price range start,Price range end,Currency,Category ID,Category path,'
           'Ranking category ID,Ranking category path\n'
           '2,+3,"Runner, blue",12345678905.0,Acme,In stock,Not in inventory,10.5,20,USD,1,Shoes,1,Shoes\n'
           '1,New,Trail,0012345678905,Other,In stock,In stock,30,40,USD,1,Shoes,1,Shoes\n')


def test_blank_ranking_code_matches_through_the_decimal_form(spark, tmp_path):
    from shelfwise.operators.joins import gtin_pairs
    (tmp_path / "r.csv").write_text("Popularity rank,GTIN\n1,100000000037\n2,\n")
    ranking = read_ranking(spark, str(tmp_path), dt.date(2024, 1, 15))
    assert rows(ranking, "Pop", "GTIN") == [(1, "100000000037.0"), (2, "nan")]
    feed = spark.createDataFrame([("g1", "100000000037")], "GID string, GTIN string")
    assert rows(gtin_pairs(feed, ranking)) == [(1, "g1")]


def test_ranking_csv(spark, tmp_path):
    path = tmp_path / "ranking.csv"
    path.write_text(RANKING)
    df = read_ranking(spark, str(path), dt.date(2024, 1, 15))
    assert df.columns == ["Pop", "ChangeFromLastWeek", "Title", "GTIN", "Brand", "BrandInventoryStatus",
                          "ProductInventoryStatus", "PriceRangeStart", "PriceRangeEnd", "WeekNumber"]
    assert rows(df) == [
        (1, "New", "Trail", "0012345678905", "Other", "In stock", "In stock", 30.0, 40.0, "3"),
        (2, "+3", "Runner, blue", "12345678905.0", "Acme", "In stock", "Not in inventory", 10.5, 20.0, "3")]


ADS_FILE_1 = ("Shopping - Product Titles - 7 days (Jan 8, 2024-Jan 14, 2024)\n"
              "Day,Item Id,Product type (1st level),Impressions,Clicks,Cost,Account,Total conv. value\n"
              "2024-01-08,g1-10.5|us,g1 shoes,100,3,2500000,ACCOUNT US,12.5\n"
              "2024-01-09,,G2,0,0,0,ACCOUNT UK,0\n"
              "2024-01-14,g1-9.5|us,g1,40,x,1000000,ACCOUNT US,3\n")
ADS_FILE_2 = ("Shopping - Product Titles - 7 days (Jan 15, 2024-Jan 21, 2024)\n"
              "Day,Item Id,Product type (1st level),Impressions,Clicks,Cost,Account,Total conv. value\n"
              "2024-01-15,g3-8.5|us,g3,5,1,0,ACCOUNT US,1\n")


def test_ads_report_drops_title_and_header_lines(spark, tmp_path):
    (tmp_path / "w1.csv").write_text(ADS_FILE_1)
    (tmp_path / "w2.csv").write_text(ADS_FILE_2)
    df = ADS.read_ads(spark, str(tmp_path))
    assert dict(df.dtypes) == {"Date": "date", "OfferID": "string", "GID": "string", "Impressions": "bigint",
                               "Clicks": "bigint", "Cost": "bigint", "Account": "string",
                               "ConversionValue": "double"}
    got = rows(df, "Date", "OfferID", "Clicks", "Cost")
    assert got == [(dt.date(2024, 1, 8), "g1-10.5|us", 3, 2500000), (dt.date(2024, 1, 9), None, 0, 0),
                   (dt.date(2024, 1, 14), "g1-9.5|us", None, 1000000), (dt.date(2024, 1, 15), "g3-8.5|us", 1, 0)]
    week = ADS.last_week(df, dt.date(2024, 1, 15))          # Jan 8..14, no zero impressions
    assert rows(week, "Date") == [(dt.date(2024, 1, 8),), (dt.date(2024, 1, 14),)]
    assert ADS.date_range(df, dt.date(2024, 1, 1), dt.date(2024, 1, 31)).columns == [
        "Date", "GID", "Impressions", "Clicks", "Cost", "Account", "ConversionValue"]


def test_ads_writer_round_trip(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 8), "g1 shoes, red", "g1-1|us", "A", 5, 1, 10, 1.5)],
                               "Date date, GID string, OfferID string, Account string, Impressions bigint, "
                               "Clicks bigint, Cost bigint, ConversionValue double")
    path = FX.scratch_path(spark, "test-ads")
    FX.write_ads_report(df, path)
    assert rows(ADS.read_ads(spark, path), *df.columns) == rows(df)


def _response(dims, metrics, data):
    return {"reports": [{
        "columnHeader": {"dimensions": dims,
                         "metricHeader": {"metricHeaderEntries": [{"name": m, "type": "INTEGER"} for m in metrics]}},
        "data": {"rows": [{"dimensions": d, "metrics": [{"values": v}]} for d, v in data]}}]}


def test_analytics_responses_flatten_every_report(spark, tmp_path):
    dims = ["ga:date", "ga:productName", "ga:productSku", "ga:country", "ga:dimension9"]
    metrics = ["ga:itemRevenue", "ga:itemQuantity"]
    first = _response(dims, metrics, [(["20240108", "Shoe, red", "G1", "United States", "US 10.5Wm"], ["12.7", "1"]),
                                      (["20240108", "(not set)", "g2", "Canada", "UK 9"], ["abc", "2"])])
    second = _response(dims, metrics, [(["20240109", "Shoe", "g1", "United States", "(not set)"], ["3", "1"])])
    both = {"reports": first["reports"] + second["reports"]}
    (tmp_path / "day.json").write_text(json.dumps(both, indent=2))
    flat = AN.flatten_responses(AN.read_responses(spark, str(tmp_path / "day.json"), multi_line=True),
                                dims + metrics)
    renamed = AN.rename_fields(flat, {**AN.ANALYTICS_RENAMES, "ga:dimension9": "size"})
    assert renamed.columns == ["date", "productName", "productSku", "country", "size", "itemRevenue", "itemQuantity"]
    assert rows(renamed) == [
        ("20240108", "(not set)", "g2", "Canada", "UK 9", "abc", "2"),
        ("20240108", "Shoe, red", "G1", "United States", "US 10.5Wm", "12.7", "1"),
        ("20240109", "Shoe", "g1", "United States", "(not set)", "3", "1")]


HITS = [("20240108", 1, "view", "Shoe 1", "g1", "United States", "google / cpc", 0, 1),
        ("20240108", 1, "purchase", "Shoe 1", "g1", "United States", "google / cpc", 1250, 2),
        ("20240108", 2, "purchase", "Shoe 1", "g1", "Canada", "google / organic", 500, 1),
        ("20240108", 2, "click", "Shoe 1", "g1", "United States", "google / cpc", 0, 1),
        ("20240108", 3, "purchase", "Shoe 1", "g1", "United States", "google / cpc", 100, 1),
        ("20240109", 4, "purchase", "Shoe 2", "g2", "Canada", "google / cpc", 10, 3)]
HIT_SCHEMA = ("date string, user_id bigint, event_type string, productName string, productSku string, "
              "country string, sourceMedium string, cents bigint, quantity bigint")


def test_product_report_and_filters(spark):
    hits = spark.createDataFrame(HITS, HIT_SCHEMA)
    report = {(r["date"], r["country"]): r for r in AN.product_report(hits).collect()}
    us = report[("20240108", "United States")]
    assert (us["itemRevenue"], us["itemQuantity"], us["uniquePurchases"], us["quantityAddedToCart"]) == (1350, 3, 2, 1)
    assert us["buyToDetailRate"] == 200.0
    assert report[("20240109", "Canada")]["buyToDetailRate"] is None     # no detail view
    # user-scoped segment: user 2 qualifies through the click, so its Canada purchase stays
    seg = AN.user_segment(hits)
    assert sorted({r["user_id"] for r in seg.collect()}) == [1, 2, 3]
    assert seg.filter(F.col("country") == "Canada").count() == 1
    assert AN.traffic_source(hits).count() == 5


def test_append_sink_and_partition_replace(spark):
    path = FX.scratch_path(spark, "test-sink")
    schema = "report_monday date, WeekNumber string, ID string, v int"
    first, second = dt.date(2024, 1, 8), dt.date(2025, 1, 6)     # week 2 of either year
    df = spark.createDataFrame([(first, "2", "a", 1), (second, "2", "b", 2)], schema)
    SINK.append_table(df, path, partition_by=["report_monday"])
    SINK.append_table(df, path, partition_by=["report_monday"])
    assert spark.read.parquet(path).count() == 4
    rerun = spark.createDataFrame([(second, "2", "b", 9)], schema)
    SINK.append_table(rerun, path, partition_by=["report_monday"], replace_partitions=True)
    table = spark.read.parquet(path)
    assert dict(table.dtypes)["WeekNumber"] == "string" and dict(table.dtypes)["report_monday"] == "date"
    assert rows(table, "report_monday", "WeekNumber", "ID", "v") == [
        (first, "2", "a", 1), (first, "2", "a", 1), (second, "2", "b", 9)]
    out = FX.scratch_path(spark, "test-csv")
    SINK.dump_csv(df, out)
    assert spark.read.option("header", "true").csv(out).count() == 2


def test_rate_history_unpivot_and_conversion(spark, tmp_path):
    from shelfwise.operators.currency import convert
    from shelfwise.sources.rates import read_rates
    (tmp_path / "rates.csv").write_text(
        "Date,USD,JPY,GBP,\n2024-01-29,1.0823,160.1,0.8526,\n2024-01-26,1.0871,N/A,0.8541,\n")
    rates = read_rates(spark, str(tmp_path / "rates.csv"))
    got = rows(rates)
    assert (dt.date(2024, 1, 26), "EUR", 1.0) in got and (dt.date(2024, 1, 29), "JPY", 160.1) in got
    assert not any(r[1] == "JPY" and r[0] == dt.date(2024, 1, 26) for r in got)
    df = spark.createDataFrame([(10.823,)], "x double")
    y = df.select(convert(F.col("x"), rates, "USD", "GBP").alias("y")).first()["y"]
    assert abs(y - 10.823 / 1.0823 * 0.8526) < 1e-12


def test_analytics_response_stream(spark, tmp_path):
    from shelfwise.streaming import analytics_response_stream, append_new_files
    landing = tmp_path / "an"
    landing.mkdir()
    doc = _response(["ga:date", "ga:productSku"], ["ga:itemRevenue"],
                    [(["20240108", "g1"], ["5"]), (["20240109", "g2"], ["7"])])
    (landing / "d1.json").write_text(json.dumps(doc))
    table, ckpt = FX.scratch_path(spark, "an-table"), FX.scratch_path(spark, "an-ckpt")
    stream = analytics_response_stream(spark, str(landing), ["ga:date", "ga:productSku", "ga:itemRevenue"])
    append_new_files(stream, table, ckpt)
    assert rows(spark.read.parquet(table), "date", "productSku", "itemRevenue") == [
        ("20240108", "g1", "5"), ("20240109", "g2", "7")]


def test_short_rows_and_missing_fields_give_null(spark, tmp_path):
    doc = _response(["ga:date", "ga:productSku"], ["ga:itemRevenue", "ga:itemQuantity"],
                    [(["20240108", "g1"], ["5"]), (["20240109", "g2"], ["7", "2"])])
    (tmp_path / "r.json").write_text(json.dumps(doc))
    flat = AN.flatten_responses(AN.read_responses(spark, str(tmp_path / "r.json")),
                                ["ga:date", "ga:itemRevenue", "ga:itemQuantity", "ga:country"])
    assert rows(flat) == [("20240108", "5", None, None), ("20240109", "7", "2", None)]


def test_ranking_columns_by_name(spark, tmp_path):
    path = tmp_path / "reordered.csv"
    path.write_text('GTIN,Popularity rank,Extra,Title,Price range start\n'
                    '0012,7,x,"A, b",1.5\n0013,bad,y,C,2\n')
    df = read_ranking(spark, str(path), dt.date(2024, 1, 15))
    assert rows(df, "Pop", "GTIN", "Title", "PriceRangeStart", "Brand") == [
        (None, "13", "C", 2.0, None), (7, "12", "A, b", 1.5, None)]
    text = read_ranking(spark, str(path), dt.date(2024, 1, 15), gtin_text=True)
    assert rows(text, "GTIN") == [("0012",), ("0013",)]


def test_each_ranking_file_follows_its_own_header(spark, tmp_path):
    """Reversed columns, a missing one, a repeated header line, a byte order
    mark and a header after a blank line, all in one read."""
    (tmp_path / "a.csv").write_text("Popularity rank,Title,GTIN,Price range start\n1,A,111,2.5\n\nPopularity rank,Title,GTIN,Price range start\n2,,222,3\n")
    (tmp_path / "b.csv").write_text("\ufeffPrice range start,GTIN,Title,Popularity rank\n9.5,333,\"B, or \"\"C\"\"\",3\n".replace('""C""', '\\"C\\"'))
    (tmp_path / "c.csv").write_text("\nGTIN,Popularity rank\n0444,4\n,5\n")
    got = rows(read_ranking(spark, str(tmp_path), dt.date(2024, 1, 15)), "Pop", "Title", "GTIN", "PriceRangeStart", "BrandInventoryStatus")
    assert got == [(1, "A", "111", 2.5, None), (2, None, "222", 3.0, None), (3, 'B, or "C"', "333", 9.5, None),
                   (4, None, "444.0", None, None), (5, None, "nan", None, None)]
    (tmp_path / "d.csv").write_text("6,no header\n")
    with pytest.raises(Exception, match="no header line"):
        read_ranking(spark, str(tmp_path), dt.date(2024, 1, 15)).collect()


def test_each_rates_file_follows_its_own_header(spark, tmp_path):
    from shelfwise.sources.rates import read_rates
    (tmp_path / "a.csv").write_text("Date,USD,GBP,\n2024-01-26,1.1,0.85,\n")
    (tmp_path / "b.csv").write_text("GBP,Date,JPY\n0.86,2024-01-29,160\n")
    assert rows(read_rates(spark, str(tmp_path)), "rate_date", "currency", "per_eur") == sorted([
        (dt.date(2024, 1, 26), "EUR", 1.0), (dt.date(2024, 1, 26), "GBP", 0.85), (dt.date(2024, 1, 26), "USD", 1.1),
        (dt.date(2024, 1, 29), "EUR", 1.0), (dt.date(2024, 1, 29), "GBP", 0.86), (dt.date(2024, 1, 29), "JPY", 160.0)])


def test_ads_report_columns_follow_the_header(spark, tmp_path):
    text = ("Shopping - Product Titles - 4 weeks\n"
            "Clicks,Day,Account,Product type (1st level),Impressions,Cost,Total conv. value\n"
            "3,2024-01-08,ACCOUNT US,g1 shoes,100,2500000,12.5\n")
    (tmp_path / "range.csv").write_text(text)
    df = ADS.read_ads(spark, str(tmp_path))
    assert "OfferID" not in df.columns
    assert rows(df, "Date", "GID", "Clicks", "Impressions", "Cost", "ConversionValue") == [
        (dt.date(2024, 1, 8), "g1 shoes", 3, 100, 2500000, 12.5)]


def test_each_report_file_follows_its_own_header(spark, tmp_path):
    """Two column orders in one folder, one header after line 60."""
    late = "".join(f"note {i}\n" for i in range(60))
    (tmp_path / "a.csv").write_text(late + "Day,Product type (1st level),Impressions,Clicks,Cost,Account,Total conv. value\n"
                                    "2024-01-08,g1,10,1,5,A,1\n")
    (tmp_path / "b.csv").write_text("Title\nClicks,Impressions,Day,Item Id,Product type (1st level),Cost,Account,Total conv. value\n"
                                    '2,20,2024-01-09,o,"g2, red",6,A,2\n')
    got = rows(ADS.read_ads(spark, str(tmp_path)), "GID", "Impressions", "Clicks", "OfferID", "Cost")
    assert got == [("g1", 10, 1, None, 5), ("g2, red", 20, 2, "o", 6)]


def test_report_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("2024-01-08,g1,10,1,5,A,1\n")
    with pytest.raises(ValueError, match="no header"):
        ADS.read_ads(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("Day,Product type (1st level),Impressions,Clicks,Cost,Account,Total conv. value\n")
    with pytest.raises(Exception, match="no header line in"):
        ADS.read_ads(spark, str(tmp_path)).collect()


def test_broken_analytics_document_is_reported_or_diverted(spark, tmp_path):
    doc = json.dumps(_response(["ga:date"], ["ga:itemRevenue"], [(["20240108"], ["5"])]))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.json").write_text(doc + "\n" + doc[:-20] + "\n\n{}\n")
    with pytest.raises(Exception, match="bad analytics document"):
        AN.flatten_responses(AN.read_responses(spark, str(tmp_path / "in")), ["ga:date"]).collect()
    good = AN.read_responses(spark, str(tmp_path / "in"), divert_to=str(tmp_path / "bad"))
    assert rows(AN.flatten_responses(good, ["ga:date", "ga:itemRevenue"])) == [("20240108", "5")]
    assert rows(spark.read.text(str(tmp_path / "bad"))) == sorted([(doc[:-20],), ("{}",)])


def test_append_catalog_table(spark):
    df = spark.createDataFrame([("3", "a", 1)], "WeekNumber string, ID string, v int")
    SINK.append_catalog_table(df, "shelfwise_test_popular", partition_by=["WeekNumber"])
    SINK.append_catalog_table(df, "shelfwise_test_popular", partition_by=["WeekNumber"])
    assert spark.table("shelfwise_test_popular").count() == 2
    spark.sql("DROP TABLE shelfwise_test_popular")


def _hits(spark, rows_):
    return spark.createDataFrame(
        [(d, u, t, f"Shoe {p}", f"g{p}", c, m, cents, 1) for d, u, t, p, c, m, cents in rows_],
        "date string, user_id long, event_type string, productName string, productSku string, country string, "
        "sourceMedium string, cents long, quantity long")


US, CPC, ORGANIC = "United States", "google / cpc", "google / organic"


def test_segment_request_keeps_members_whose_matching_hit_is_not_paid(spark):
    """User 1 is American by an organic hit only, and buys in Canada through a
    paid click; user 2 never matches; user 3 has no paid hit; a hit without a
    user belongs to nobody."""
    hits = _hits(spark, [
        ("20240108", 1, "view", 1, US, ORGANIC, 0), ("20240108", 1, "purchase", 1, "Canada", CPC, 500),
        ("20240108", 1, "view", 1, "Canada", CPC, 0), ("20240108", 1, "purchase", 1, "Canada", ORGANIC, 70),
        ("20240108", 2, "purchase", 1, "Canada", CPC, 900), ("20240108", 3, "purchase", 2, US, ORGANIC, 40),
        ("20240108", None, "purchase", 1, US, CPC, 5), ("20240108", 1, "click", 1, "Canada", None, 0)])
    report = AN.segment_report(hits, where=AN.from_source(), name="US users, paid")
    assert [r.asDict() for r in report.collect()] == [{
        "date": "20240108", "productName": "Shoe 1", "productSku": "g1", "country": "Canada", "itemRevenue": 500,
        "itemQuantity": 1, "uniquePurchases": 1, "quantityAddedToCart": 0, "buyToDetailRate": 100.0, "segment": "US users, paid"}]
    # filtering first would lose user 1 from the segment
    assert AN.segment_report(AN.traffic_source(hits)).count() == 0
    whole = AN.segment_report(hits)
    assert rows(whole, "productSku", "country", "itemRevenue", "segment") == [
        ("g1", "Canada", 570, US), ("g1", US, 0, US), ("g2", US, 40, US)]


def test_buyers_merge_over_days(spark):
    hits = _hits(spark, [(f"202401{d:02d}", u, "purchase" if u != 3 else "view", p, US, CPC, 1)
                         for d in range(8, 15) for p in range(2) for u in (1, 2, 3, d, 40_000 + d % 2, None)])
    daily = AN.daily_buyers(hits, ["productSku"])
    raw = hits.filter("event_type = 'purchase'")
    got = AN.buyers_over_days(daily, ["productSku"])
    assert rows(got) == rows(raw.groupBy("productSku").agg(F.count_distinct("user_id").alias("n")))
    per_day = AN.buyers_over_days(daily, ["date", "productSku"])
    assert rows(per_day) == rows(raw.filter("user_id is not null").groupBy("date", "productSku").agg(F.count_distinct("user_id").alias("n")))
    assert AN.buyers_over_days(AN.daily_buyers(hits.limit(0)), ["productSku"]).count() == 0


def test_user_numbers_are_dense_and_stay(spark):
    users = lambda names: spark.createDataFrame([(n,) for n in names], "client_id string")
    first = AN.dense_users(users(["b", "a", None, "a", "ü"] + [f"u{i}" for i in range(300)]))
    known = {r["user"]: r["number"] for r in first.collect()}
    assert sorted(known.values()) == list(range(303))
    stored = spark.createDataFrame(list(known.items()), "user string, number long")
    second = {r["user"]: r["number"] for r in AN.dense_users(users(["new", "a", "newer"]), stored).collect()}
    assert {u: second[u] for u in known} == known and sorted([second["new"], second["newer"]]) == [303, 304]


ITEM = "<item><g:id>{0}</g:id><g:item_group_id>g{0}</g:item_group_id></item>"


def test_bad_feed_items_stop_the_read_or_are_diverted(spark, tmp_path):
    """A wrong end tag, a missing one, and a file cut in the middle of an item
    take nothing else with them; comments, CDATA, attributes and empty items
    are read; each file is cut by itself."""
    good = [ITEM.format(n) for n in range(40)]
    (tmp_path / "a.xml").write_text("\n<?xml version='1.0'?><rss><channel><title>t</title>" + "\n".join(
        good[:20] + ["<item><g:id>bad1</g:idd></item>"] + good[20:30] + ["<item><g:id>bad2</g:id>"]
        + ["<item no='1'\n><g:id><![CDATA[a <b>]]></g:id></item>", "<item/>", "<item />"]) + "</channel></rss>")
    (tmp_path / "b.xml").write_text("<rss><channel>" + "".join(good[30:]) + "<item><g:id>bad3</g:id>")
    bad = tmp_path / "bad"
    got = read_feed(spark, [str(tmp_path / "a.xml"), str(tmp_path / "b.xml")], divert_to=str(bad))
    ids = [r["ID"] for r in got.collect()]
    assert sorted(i for i in ids if i) == sorted([str(n) for n in range(40)] + ["a <b>"]) and ids.count(None) == 2
    diverted = [r["value"] for r in spark.read.json(str(bad)).collect()]
    assert sorted(d[12:16] for d in diverted) == ["bad1", "bad2", "bad3"]
    with pytest.raises(Exception, match="bad feed item: <item><g:id>bad"):
        read_feed(spark, str(tmp_path / "a.xml")).count()            # also where no column is read


def test_feed_without_items(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><title>empty</title></channel></rss>")
    assert read_feed(spark, str(tmp_path), divert_to=str(tmp_path / "bad")).count() == 0


def test_replacing_needs_partitions(spark):
    path = FX.scratch_path(spark, "test-replace")
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    SINK.append_table(df, path)
    with pytest.raises(ValueError, match="partition_by"):
        SINK.append_table(df, path, replace_partitions=True)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="partition_by"):
        SINK.append_catalog_table(df, "never_made", replace_partitions=True)


def test_catalog_partitions_are_replaced(spark):
    one = spark.createDataFrame([("2024-01-08", 1), ("2024-01-15", 2)], "week string, v int")
    spark.sql("DROP TABLE IF EXISTS replaced_weeks")
    SINK.append_catalog_table(one, "replaced_weeks", ["week"], replace_partitions=True)     # the first use creates it
    SINK.append_catalog_table(spark.createDataFrame([("2024-01-15", 9)], "week string, v int"), "replaced_weeks",
                              ["week"], replace_partitions=True)
    SINK.append_catalog_table(one.limit(1), "replaced_weeks", ["week"])
    assert rows(spark.table("replaced_weeks"), "week", "v") == [("2024-01-08", 1), ("2024-01-08", 1), ("2024-01-15", 9)]
    spark.sql("DROP TABLE IF EXISTS plain_rows")
    SINK.append_catalog_table(one, "plain_rows")
    with pytest.raises(ValueError, match="no partitions"):
        SINK.append_catalog_table(one, "plain_rows", replace_partitions=True)


def test_partition_folders_get_files_by_their_bytes(spark):
    """40 tasks and 3 days, one of them with nearly all rows: not 120 files,
    and the large day is split."""
    import glob
    df = spark.range(0, 200_000, 1, 40).select(
        F.when(F.col("id") % 100 == 0, "2024-01-01").when(F.col("id") % 100 == 1, "2024-01-02")
        .otherwise("2024-01-03").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    path = FX.scratch_path(spark, "test-layout")
    SINK.append_table(df, path, ["day"], target_bytes=2 << 20)
    files = {d: glob.glob(f"{path.removeprefix('file:')}/day={d}/*.parquet") for d in ("2024-01-01", "2024-01-02", "2024-01-03")}
    assert len(files["2024-01-01"]) == len(files["2024-01-02"]) == 1
    assert 4 <= len(files["2024-01-03"]) <= 16           # about 14 MB of rows
    assert spark.read.parquet(path).count() == 200_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != str(2 << 20)


def test_unlisted_headers_are_kept(spark, tmp_path):
    """A report with a column that nobody listed, one without, a short row, a
    repeated and an odd name."""
    docs = [_response(["ga:date", "ga:new 'one\""], ["ga:itemRevenue", "ga:itemRevenue"], [(["20240108", "x, y"], ["5", "6"]), (["20240109"], [])]),
            _response(["ga:date"], [], [(["20240110"], [])])]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(d) for d in docs))
    flat = AN.flatten_responses(AN.read_responses(spark, str(tmp_path / "r.json")), ["ga:date"], others="others")
    table = FX.scratch_path(spark, "test-variant")
    SINK.append_table(flat, table)
    stored = spark.read.parquet(table)
    got = stored.select("ga:date", AN.other_field("ga:new 'one\"").alias("a"), AN.other_field("ga:itemRevenue").alias("b"),
                        AN.other_field("ga:none").alias("c"), F.col("others").isNull().alias("d"))
    assert rows(got) == [("20240108", "x, y", "5", None, False), ("20240109", None, None, None, True),
                         ("20240110", None, None, None, True)]
