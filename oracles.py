"""DuckDB SQL for the registered queries, written from the operators'

The statements share a few facts, each one row per thing it names:

* ``spend``: ad totals per run, product group, month and year;
* ``demand``: analytics totals per run, product, name and month;
* ``looks``: a product group's images with their brand;
* ``ranks``: the ranks that a product group's codes match;
* ``week_spend`` / ``week_demand``: the same by week, for the decline rule;
* ``size_units`` / ``size_cost``: sizes sold and paid for per day;
* ``variants`` / ``day_cost``: for the margins.

``runs`` holds the period of each weekly run.  Doubles are rounded to 6 places
on both sides; money stays in integer cents / micros until the final division.
"""

from __future__ import annotations

import datetime as _dt

DEFAULT_RUN_DATE = _dt.date(2024, 1, 15)   # Monday; report week 2024-01-08 .. 2024-01-14
REPORT_MONDAYS = [_dt.date(2024, 1, 1) + _dt.timedelta(weeks=n) for n in range(4)]


def week_of(day: _dt.date) -> int:
    return int(day.strftime("%W")) + 1


WEEK_NUMBER = str(week_of(REPORT_MONDAYS[1]))
DECLINE_START, DECLINE_END = REPORT_MONDAYS[0], REPORT_MONDAYS[3] + _dt.timedelta(days=6)
WEEK_RANGE = f"{week_of(DECLINE_START)} - {week_of(DECLINE_END)}  -  {DECLINE_START} - {DECLINE_END}"

INT_DATE = r"regexp_full_match(date, '\s*[+-]?[0-9]+\s*')"
DIGITS = r"'[^\p{Nd}.]+'"
DAY = "CAST(strptime(date, '%Y%m%d') AS DATE)"
SKU = "lower(regexp_replace(GID, ' .*$', ''))"
RAW_SKU = "regexp_replace(GID, ' .*$', '')"
WEEK = "CAST(strftime({0}, '%W') AS INTEGER) + 1"

STANDINS = f"""
e AS (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS dt,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events),
feed AS (
  SELECT 'g' || CAST(p_partkey % 500 AS VARCHAR) AS GID,
         'G' || CAST(p_partkey % 500 AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS ID,
         CAST(100000000000 + p_partkey * 37 AS VARCHAR) AS GTIN,
         'img/' || CAST(p_partkey % 100 AS VARCHAR) AS IMG,
         p_brand AS BRAND,
         CAST(p_partkey % 4 * 10 AS VARCHAR) || '%' AS Margin,
         CAST(p_size AS VARCHAR) AS Size
  FROM part),
popular AS (
  SELECT CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS Pop,
         CAST(p_partkey % 7 - 3 AS VARCHAR) AS ChangeFromLastWeek,
         p_name AS Title,
         CAST(100000000000 + p_partkey * 37 AS VARCHAR) || '.0' AS GTIN,
         p_brand AS Brand,
         CASE WHEN p_partkey % 2 = 0 THEN 'In stock' ELSE 'Not in inventory' END AS BrandInventoryStatus,
         CASE WHEN p_partkey % 3 = 0 THEN 'Not in inventory' ELSE 'In stock' END AS ProductInventoryStatus,
         p_retailprice AS PriceRangeStart,
         p_retailprice + p_size AS PriceRangeEnd,
         '{WEEK_NUMBER}' AS WeekNumber
  FROM part),
ads AS (
  SELECT dt AS Date,
         'G' || CAST(user_id % 500 AS VARCHAR) || ' shoes' AS GID,
         'G' || CAST(user_id % 500 AS VARCHAR) || '-' || CAST(event_id % 15 AS VARCHAR) || '.5|US' AS OfferID,
         CASE WHEN event_id % 5 = 0 THEN 'ACCOUNT UK' ELSE 'ACCOUNT US' END AS Account,
         CAST(CASE WHEN event_type = 'view' THEN 40 ELSE 5 END AS BIGINT) AS Impressions,
         CAST(CASE WHEN event_type = 'click' THEN 30 ELSE 1 END AS BIGINT) AS Clicks,
         CASE WHEN event_id % 97 = 0 THEN CAST(0 AS BIGINT) ELSE cents * 10000 END AS Cost,
         CAST(cents AS DOUBLE) / 100 AS ConversionValue
  FROM e WHERE event_type IN ('click', 'view', 'error')),
analytics AS (
  SELECT strftime(dt, '%Y%m%d') AS date,
         CASE WHEN event_id % 11 = 0 THEN '(not set)' ELSE 'Shoe ' || CAST(user_id % 500 AS VARCHAR) END AS productName,
         'g' || CAST(user_id % 500 AS VARCHAR) AS productSku,
         CASE WHEN event_id % 6 = 0 THEN 'Canada' ELSE 'United States' END AS country,
         'US ' || CAST(event_id % 15 AS VARCHAR) || '.5Wm' AS size,
         CASE WHEN event_id % 7 = 0 THEN 'Bags' ELSE 'Shoes' END AS productType,
         cents AS itemRevenue,
         event_id % 100 AS buyToDetailRate,
         1 + event_id % 3 AS itemQuantity
  FROM e WHERE event_type IN ('purchase', 'signup')),
top2000 AS (FROM popular ORDER BY Pop, GTIN LIMIT 2000)"""



def with_standins(body: str) -> str:
    return f"WITH {STANDINS},\n{body}"


def _plain(body: str) -> str:
    return f"WITH {STANDINS}\n{body}"


def _runs(mondays: list[_dt.date] | None) -> str:
    """The periods of weekly runs, or one period that holds everything."""
    rows = ([(m, m + _dt.timedelta(days=6), week_of(m)) for m in mondays] if mondays
            else [(_dt.date(1900, 1, 1), _dt.date(2999, 12, 31), WEEK_NUMBER)])
    return "runs(first_day, last_day, label) AS (VALUES " + ", ".join(
        f"(DATE '{a}', DATE '{b}', '{n}')" for a, b, n in rows) + ")"


# ------------------------------------------------------ products that do sell

def _key(x: str, drop: int) -> str:
    return f"left({x}, greatest(length({x}) - {drop}, 0))"


SELLING = rf"""
spend AS (
  SELECT label, {SKU} AS sku, strftime(Date, '%m') AS mon, strftime(Date, '%Y') AS yr,
         CAST(sum(Impressions) AS BIGINT) AS Impressions, CAST(sum(Clicks) AS BIGINT) AS Clicks,
         CAST(sum(Cost) AS BIGINT) AS Cost, sum(ConversionValue) AS ConversionValue
  FROM ads JOIN runs ON Date BETWEEN first_day AND last_day
  WHERE Account = 'ACCOUNT US' AND Impressions > 0 GROUP BY ALL),
demand AS (
  SELECT label, productSku, productName, country, strftime(day, '%m') AS mon, strftime(day, '%Y') AS yr,
         CAST(sum(itemRevenue) AS BIGINT) AS itemRev, avg(buyToDetailRate) AS rate
  FROM (SELECT *, {DAY} AS day FROM analytics WHERE {INT_DATE}) JOIN runs ON day BETWEEN first_day AND last_day
  WHERE country = 'United States' GROUP BY ALL),
looks AS (SELECT lower(GID) AS sku, IMG, min(BRAND) AS BRAND FROM feed GROUP BY ALL),
ranks AS (
  SELECT DISTINCT lower(feed.GID) AS sku, top2000.Pop
  FROM feed JOIN top2000 ON {_key('feed.GTIN', 2)} = {_key('top2000.GTIN', 4)}),
priced AS (SELECT *, CAST(Cost AS DOUBLE) / 1000000 AS newCost FROM spend),
ds AS (
  SELECT p.sku AS ID, Impressions, Cost, Clicks, ConversionValue, IMG, BRAND, Pop, itemRev,
         rate AS buyToDetailRate, productName, country, p.mon AS monthNum, p.yr AS yearNum, newCost,
         if(newCost <= 0, 0.0, CAST(itemRev AS DOUBLE) / newCost) AS newROAS, p.label AS WeekNumber
  FROM demand d
  JOIN priced p ON (p.label, p.sku, p.mon, p.yr) = (d.label, lower(d.productSku), d.mon, d.yr)
  JOIN looks USING (sku) JOIN ranks USING (sku))"""

DS_COLS = """ID, Impressions, Cost, Clicks, round(ConversionValue, 6) AS ConversionValue, IMG, BRAND, Pop,
  itemRev, round(buyToDetailRate, 6) AS buyToDetailRate, productName, country, monthNum, yearNum,
  round(newCost, 6) AS newCost, round(newROAS, 6) AS newROAS, WeekNumber"""


def _selling(body: str, mondays: list[_dt.date] | None = None) -> str:
    return with_standins(f"{_runs(mondays)},{SELLING}\n{body}")


def _stored(body: str) -> str:
    """Over the do_sell table that four weekly runs appended."""
    return _selling(body, REPORT_MONDAYS)


def _rollup(period: str, alias: str, clicks: str, rows: str) -> str:
    mean = lambda x, name: f"round(avg({x}) + 1e-9, 6) AS {name}"  # noqa: E731  off exact ties
    return f"""
SELECT {period} AS {alias}, yearNum AS YearNum, ID, BRAND, productName, country, max(IMG) AS IMG,
  round({clicks} + 1e-9, 6) AS Clicks, round(avg(Clicks) / nullif(avg(Impressions), 0) + 1e-9, 6) AS CTR,
  {mean('Impressions', 'Impressions')}, {mean('newCost', 'newCost')}, {mean('ConversionValue', 'ConversionValue')},
  {mean('Pop', 'Pop')}, {mean('itemRev', 'itemRev')}, {mean('buyToDetailRate / 100', 'BTDR')}, {mean('newROAS', 'ROAS')}
FROM {rows} GROUP BY ALL"""


def _view(period: str, alias: str, clicks: str) -> str:
    """As the view is defined: IDs with a row whose Pop is among all groups'
    smallest ones, joined to the table."""
    smallest = f"(SELECT min(Pop) FROM ds GROUP BY ID, {period}, yearNum)"
    chosen = f"(SELECT ID, avg(Pop) AS mean_pop FROM ds WHERE Pop IN {smallest} GROUP BY ID)"
    return _stored(_rollup(period, alias, clicks, f"(SELECT ds.* FROM ds JOIN {chosen} x ON ds.ID = x.ID)"))


FIRST_RANKS = "(SELECT DISTINCT min(Pop) OVER (PARTITION BY ID, monthNum, yearNum) AS Pop FROM ds)"

# -------------------------------------------------------------------- decline

WEEKLY = rf"""
week_spend AS (
  SELECT {RAW_SKU} AS gid, Account, {WEEK.format('Date')} AS weekNum, strftime(Date, '%Y') AS yearNum,
         CAST(sum(Impressions) AS BIGINT) AS Impressions, CAST(sum(Clicks) AS BIGINT) AS Clicks,
         CAST(sum(Cost) AS BIGINT) AS Cost, sum(ConversionValue) AS ConversionValue
  FROM ads
  WHERE Account = 'ACCOUNT US' AND Impressions > 0 AND Date BETWEEN DATE '{DECLINE_START}' AND DATE '{DECLINE_END}'
  GROUP BY 1, 2, 3, 4 QUALIFY sum(sum(Clicks)) OVER (PARTITION BY {RAW_SKU}) > 400),
week_demand AS (
  SELECT country, productSku, lower(productName) AS productName, {WEEK.format('day')} AS weekNum,
         strftime(day, '%Y') AS yearNum, CAST(sum(itemRevenue) AS BIGINT) AS itemRev, avg(buyToDetailRate) AS rate
  FROM (SELECT *, {DAY} AS day FROM analytics WHERE {INT_DATE})
  WHERE country = 'United States' AND day BETWEEN DATE '{DECLINE_START}' AND DATE '{DECLINE_END}' GROUP BY ALL),
weeks AS (
  SELECT gid AS ID, Impressions, Cost, Clicks, ConversionValue, itemRev, rate AS buyToDetailRate,
         min(productName) AS productName, country, s.weekNum, s.yearNum
  FROM week_spend s JOIN week_demand d
    ON (lower(gid), s.weekNum, s.yearNum) = (lower(productSku), d.weekNum, d.yearNum) GROUP BY ALL),
scored AS (
  SELECT *, if(newCost <= 0, 0.0, CAST(itemRev AS DOUBLE) / newCost) AS newROAS
  FROM (SELECT *, CAST(Cost AS DOUBLE) / 1000000 AS newCost FROM weeks
        WHERE productName IS DISTINCT FROM '(not set)')),
courses AS (
  SELECT ID, list(newROAS ORDER BY weekNum, productName NULLS FIRST, Clicks NULLS FIRST, yearNum NULLS FIRST,
                  Impressions NULLS FIRST, Cost NULLS FIRST, ConversionValue NULLS FIRST, itemRev NULLS FIRST,
                  buyToDetailRate NULLS FIRST, country NULLS FIRST) AS r
  FROM scored GROUP BY ID)"""

WEEK_COLS = """ID, Impressions, Cost, Clicks, round(ConversionValue, 6) AS ConversionValue, itemRev,
  round(buyToDetailRate, 6) AS buyToDetailRate, productName, country, weekNum, yearNum"""


def _weekly(body: str) -> str:
    return with_standins(WEEKLY + "\n" + body)


def _declined(share: float) -> str:
    return f"ID IN (SELECT ID FROM courses WHERE len(r) = 4 AND NOT coalesce(r[4] >= r[1] * {share!r}, false))"


# ------------------------------------------------------------ sizes, margins

CLEAN_SIZE = "replace(replace(replace(replace(size, 'US', ''), 'UK', ''), 'Wm', 'W'), ' ', '')"
OFFER = "lower(split_part(coalesce(OfferID, 'nan'), '|', 1))"
REAL = r"'^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)'"
INT = r"'^\s*([+-]?[0-9]+)'"


def _ld(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE coalesce(TRY_CAST(regexp_extract({x}, {REAL}, 1) AS DOUBLE), 0.0) END"


def _lb(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE coalesce(TRY_CAST(regexp_extract({x}, {INT}, 1) AS BIGINT), 0) END"




def _clean_key(x: str) -> str:
    y = rf"regexp_replace({x}, '\.0$', '')"
    return f"nullif({_key(y, 2)}, '')"


SIZED = rf"""
size_units AS (
  SELECT {DAY} AS date, regexp_replace({CLEAN_SIZE}, {DIGITS}, '', 'g') AS size,
         CAST(sum(itemRevenue) AS BIGINT) AS itemRevenue, CAST(sum(itemQuantity) AS BIGINT) AS itemQuantity
  FROM analytics JOIN runs ON {DAY} BETWEEN first_day AND last_day
  WHERE productType = 'Shoes' AND {INT_DATE} GROUP BY ALL),
size_cost AS (
  SELECT Date AS date, regexp_replace(regexp_extract({OFFER}, '[^-]*$'), {DIGITS}, '', 'g') AS size,
         CAST(sum(Cost) AS DOUBLE) / 1000000 AS Cost
  FROM ads JOIN runs ON Date BETWEEN first_day AND last_day GROUP BY ALL)"""


def _sized(body: str, mondays: list[_dt.date] | None = None, more: str = "") -> str:
    return with_standins(f"{more}{_runs(mondays)},{SIZED}\n{body}")


def _size_report(cost: str = "Cost") -> str:
    return f"""SELECT date, size, round(coalesce(itemRevenue / nullif({cost}, 0), -0.01), 6) AS ROAS,
  coalesce(CAST(itemQuantity AS DOUBLE), -0.01) AS salesVolume
FROM size_units JOIN size_cost USING (date, size)"""


MARGINED = rf"""
variants AS (SELECT DISTINCT lower(GID) AS sku, Margin, BRAND AS Brand FROM feed),
day_cost AS (SELECT Date AS date, {SKU} AS sku, CAST(sum(Cost) AS BIGINT) AS Cost
  FROM ads JOIN runs ON Date BETWEEN first_day AND last_day GROUP BY ALL),
sold AS (SELECT {DAY} AS date, lower(productSku) AS sku, productName, itemRevenue, itemQuantity
  FROM analytics JOIN runs ON {DAY} BETWEEN first_day AND last_day WHERE {INT_DATE})"""


def _margined(body: str, mondays: list[_dt.date] | None = None, more: str = "") -> str:
    return with_standins(f"{more}{_runs(mondays)},{MARGINED}\n{body}")


def _margin_report(units: str = "sum(Cost) / 1000000.0::DOUBLE") -> str:
    return f"""SELECT date, Margin, round(CAST(sum(itemRevenue) AS DOUBLE) / nullif({units}, 0), 6) AS ROAS,
  CAST(sum(itemQuantity) AS BIGINT) AS salesVolume
FROM sold JOIN variants USING (sku) JOIN day_cost USING (date, sku) GROUP BY ALL"""


THIS_WEEK = [REPORT_MONDAYS[1]]
POP_COLS = ("Pop, ChangeFromLastWeek, Title, GTIN, Brand, BrandInventoryStatus, ProductInventoryStatus, "
            "round(PriceRangeStart, 6) AS PriceRangeStart, round(PriceRangeEnd, 6) AS PriceRangeEnd, WeekNumber")
UNSOLD = ("SELECT Pop, ChangeFromLastWeek, Title, GTIN, Brand, round(PriceRangeStart, 6) AS PriceRangeStart, "
          "round(PriceRangeEnd, 6) AS PriceRangeEnd, WeekNumber FROM {0} "
          "WHERE ProductInventoryStatus = 'Not in inventory'")

PIPELINES = {
    "sizes": _sized(_size_report(), THIS_WEEK),
    "margins": _margined(_margin_report(), THIS_WEEK),
    "not_sold": _plain(UNSOLD.format("top2000")),
    "popular": _plain(f"SELECT {POP_COLS} FROM top2000"),
    "do_sell": _selling(f"SELECT {DS_COLS} FROM ds", THIS_WEEK),
    "do_sell_by_month": _view("monthNum", "Monthum", "round(avg(Clicks), 0)"),
    "do_sell_by_week": _view("WeekNumber", "WeekNum", "avg(Clicks)"),
    "decline": _weekly(f"SELECT {WEEK_COLS}, round(newCost, 6) AS newCost, round(newROAS, 6) AS newROAS, "
                       f"'{WEEK_RANGE}' AS WeekRange FROM scored WHERE {_declined(0.5)}"),
}


# ===================================================== operator-level oracles

HITS = """
h AS (
  SELECT strftime(CAST(ts AS DATE), '%Y%m%d') AS date, user_id, event_type,
         CASE WHEN event_id % 11 = 0 THEN '(not set)' ELSE 'Shoe ' || CAST(user_id % 500 AS VARCHAR) END AS productName,
         'g' || CAST(user_id % 500 AS VARCHAR) AS productSku,
         CASE WHEN event_id % 6 = 0 THEN 'Canada' ELSE 'United States' END AS country,
         'US ' || CAST(event_id % 15 AS VARCHAR) || '.5Wm' AS size,
         CASE WHEN event_id % 7 = 0 THEN 'Bags' ELSE 'Shoes' END AS productType,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0
              THEN 'google / cpc' ELSE 'google / organic' END AS sourceMedium,
         CAST(round(value * 100) AS BIGINT) AS cents,
         event_id % 3 + 1 AS quantity
  FROM events)"""


def _report(source: str, dims: str, extra: str = "") -> str:
    bought = "FILTER (event_type = 'purchase')"
    return f"""
SELECT {dims}, {extra}coalesce(CAST(sum(cents) {bought} AS BIGINT), 0) AS itemRevenue,
  coalesce(CAST(sum(quantity) {bought} AS BIGINT), 0) AS itemQuantity,
  count(DISTINCT user_id) {bought} AS uniquePurchases,
  count(*) FILTER (event_type = 'click') AS quantityAddedToCart,
  round(count(DISTINCT user_id) {bought} * 100.0::DOUBLE
        / nullif(count(*) FILTER (event_type = 'view'), 0), 6) AS buyToDetailRate
FROM {source} GROUP BY {dims}"""


SEGMENT = "(FROM h WHERE user_id IN (SELECT user_id FROM h WHERE country = 'United States'))"
PRODUCT_DIMS = "date, productName, productSku, country"
SIZE_DIMS = PRODUCT_DIMS + ", size, productType"

RATES = """
rates(rate_date, currency, per_eur) AS (
  VALUES (DATE '2024-01-02', 'USD', CAST(1.0956 AS DOUBLE)), (DATE '2024-01-02', 'GBP', CAST(0.86518 AS DOUBLE)),
         (DATE '2024-01-02', 'EUR', CAST(1.0 AS DOUBLE)), (DATE '2024-01-29', 'USD', CAST(1.0823 AS DOUBLE)),
         (DATE '2024-01-29', 'GBP', CAST(0.8526 AS DOUBLE)), (DATE '2024-01-29', 'EUR', CAST(1.0 AS DOUBLE))),
fxr AS (SELECT currency, arg_max(per_eur, rate_date) AS per_eur FROM rates GROUP BY currency)"""
USD = "(SELECT per_eur FROM fxr WHERE currency = 'USD')"
GBP = "(SELECT per_eur FROM fxr WHERE currency = 'GBP')"


ADS_COLS = ("Date, GID, OfferID, Account, Impressions, Clicks, Cost, "
            "round(ConversionValue, 6) AS ConversionValue")
AN_COLS = ("date, productName, productSku, country, size, productType, itemRevenue, "
           "buyToDetailRate, itemQuantity")
METRICS = "Impressions, Clicks, Cost, round(ConversionValue, 6) AS ConversionValue"
REV_TEXT = "CAST(itemRevenue AS VARCHAR) || 'x'"
BTDR_TEXT = "CAST(buyToDetailRate AS VARCHAR) || '.7'"
LAST_WEEK = ("DATE '2024-01-08'", "DATE '2024-01-14'")
REPORT_DAYS = ", ".join(f"'202401{d:02d}'" for d in range(8, 15))
FEED_SPEND = "(SELECT f.*, s.* FROM (SELECT lower(GID) AS sku, lower(ID) AS ID, GTIN, IMG, BRAND FROM feed) f JOIN spend s USING (sku))"
DIRTY = """
dirty AS (
  SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'b' END AS src,
         CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '12' WHEN 2 THEN '0' || code
              WHEN 3 THEN '00' || code ELSE code END AS GTIN
  FROM (SELECT *, CAST(100000000000 + p_partkey * 37 AS VARCHAR) AS code FROM part)),
formed AS (
  SELECT src, p_partkey, CASE WHEN GTIN IS NULL THEN 'nan'
         ELSE CAST(CAST(GTIN AS BIGINT) AS VARCHAR) || if(src = 'a', '.0', '') END AS GTIN FROM dirty)"""

OPERATORS = {
    "do_sell_by_month_states": PIPELINES["do_sell_by_month"],
    # ------------------------------------------------------------ sources
    "s1_feed_xml": _plain("SELECT GID, ID, GTIN, IMG, BRAND FROM feed"),
    "s1_feed_margins": _plain("SELECT Margin, GID, BRAND AS Brand FROM feed"),
    "s1_feed_decline": _plain("SELECT GID, IMG, BRAND AS Brand FROM feed"),
    "s1_feed_size": _plain("SELECT Size, ID FROM feed"),
    "s2_ranking_csv": _plain(f"SELECT {POP_COLS} FROM popular"),
    "s2_mixed_headers": _plain(f"SELECT * REPLACE (if(Pop % 2 = 1, BrandInventoryStatus, NULL) AS BrandInventoryStatus) "
                               f"FROM (SELECT {POP_COLS} FROM popular)"),
    "s1_feed_bad_items": "SELECT CAST(p_partkey AS VARCHAR) AS ID, if(p_partkey % 7 = 0 OR p_partkey % 11 = 0, NULL, "
                         "CAST(p_size AS VARCHAR)) AS Size, p_partkey % 7 = 0 OR p_partkey % 11 = 0 AS diverted FROM part",
    "s3_ads_csv": _plain(f"SELECT {ADS_COLS} FROM ads"),
    "s3_ads_mixed_headers": _plain(f"SELECT {ADS_COLS} FROM ads"),
    "s4_last_week_ads": _plain(
        f"SELECT {ADS_COLS} FROM ads WHERE Date BETWEEN {LAST_WEEK[0]} AND {LAST_WEEK[1]} AND Impressions > 0"),
    "s5_range_ads": _plain(
        "SELECT Date, GID, Account, Impressions, Clicks, Cost, round(ConversionValue, 6) AS ConversionValue "
        f"FROM ads WHERE Date BETWEEN DATE '{DECLINE_START}' AND DATE '{DECLINE_END}' AND Impressions > 0"),
    "s6_analytics_json": _plain(
        'SELECT date AS "ga:date", productName AS "ga:productName", productSku AS "ga:productSku", '
        'country AS "ga:country", size AS "ga:dimensionX", productType AS "ga:productCategoryLevelX", '
        'CAST(itemRevenue AS VARCHAR) AS "ga:itemRevenue", '
        'CAST(buyToDetailRate AS VARCHAR) AS "ga:buyToDetailRate", '
        'CAST(itemQuantity AS VARCHAR) AS "ga:itemQuantity" FROM analytics'),
    "s6_analytics_variant": _plain(
        'SELECT date AS "ga:date", productSku AS "ga:productSku", country AS "ga:country", '
        'CAST(itemRevenue AS VARCHAR) AS "ga:itemRevenue", CAST(NULL AS VARCHAR) AS "ga:nothing" FROM analytics'),
    "s7_analytics_rename": _plain(
        "SELECT date, productName, productSku, country, size, productType, "
        "CAST(itemRevenue AS VARCHAR) AS itemRevenue, CAST(buyToDetailRate AS VARCHAR) AS buyToDetailRate, "
        "CAST(itemQuantity AS VARCHAR) AS itemQuantity FROM analytics"),
    "s8_product_report": f"WITH {HITS}" + _report("h", PRODUCT_DIMS),
    "s8_report_request": f"WITH {HITS}" + _report(f"(FROM {SEGMENT} WHERE sourceMedium = 'google / cpc')", PRODUCT_DIMS,
                                                   "'US users, paid clicks' AS segment, "),
    "s8_weekly_buyers": f"WITH {HITS}\nSELECT {WEEK.format(DAY)} AS weekNum, productSku, country, "
                        "count(DISTINCT user_id) AS uniquePurchases FROM h WHERE event_type = 'purchase' GROUP BY ALL",
    "s9_size_report": f"WITH {HITS}" + _report("h", SIZE_DIMS),
    "s8_segment_report": f"WITH {HITS}" + _report(SEGMENT, PRODUCT_DIMS, "'United States' AS segment, "),
    "s9_segment_sizes": f"WITH {HITS}" + _report(SEGMENT, SIZE_DIMS, "'United States' AS segment, "),
    "s10_user_segment": f"WITH {HITS}" + _report(SEGMENT, PRODUCT_DIMS),
    "s11_traffic_source": f"WITH {HITS}" + _report("(FROM h WHERE sourceMedium = 'google / cpc')", PRODUCT_DIMS),
    "s12_append_sink": _sized(f"{_size_report()} UNION ALL {_size_report()}"),
    "s12_run_ledger": _sized(f"SELECT *, CAST(date_trunc('week', date) AS DATE) AS report_monday FROM ({_size_report()})",
                             REPORT_MONDAYS[1:3]),
    "s13_csv_dump": _margined(_margin_report()),
    # -------------------------------------------------------------- joins
    "j1_feed_ads_join": _selling(f"SELECT sku AS GID, ID, GTIN, IMG, BRAND, 'ACCOUNT US' AS Account, mon AS monthNum, yr AS yearNum, "
                                 f"{METRICS} FROM {FEED_SPEND}"),
    "j2_gtin_prefix_join": _selling(
        f"SELECT sku AS GID, {METRICS}, IMG, l.BRAND, mon AS monthNum, yr AS yearNum, Pop "
        f"FROM {FEED_SPEND} l JOIN top2000 t ON {_key('l.GTIN', 2)} = {_key('t.GTIN', 4)}"),
    "j2_heavy_key": with_standins(f"""
short_feed AS (SELECT * REPLACE (if(CAST(right(GTIN, 1) AS INTEGER) % 2 = 0, '7', GTIN) AS GTIN) FROM feed),
short_top AS (SELECT Pop, if(Pop <= 3, '12', GTIN) AS GTIN FROM top2000)
SELECT f.*, Pop FROM short_feed f JOIN short_top t ON {_key('f.GTIN', 2)} = {_key('t.GTIN', 4)}"""),
    "j3_match_rows": _selling(f"SELECT sku AS GID, {METRICS}, IMG, BRAND, mon AS monthNum, yr AS yearNum, Pop "
                              f"FROM {FEED_SPEND} JOIN ranks USING (sku)"),
    "j4_products_analytics": _selling(
        f"SELECT p.sku AS GID, {METRICS}, IMG, BRAND, p.mon AS monthNum, p.yr AS yearNum, Pop, productSku, productName, "
        "country, itemRev AS itemRevenue, round(rate, 6) AS buyToDetailRate FROM demand d "
        "JOIN spend p ON (p.sku, p.mon, p.yr) = (lower(d.productSku), d.mon, d.yr) "
        "JOIN looks USING (sku) JOIN ranks USING (sku)"),
    "j5_weekly_join": _weekly(f"SELECT {WEEK_COLS} FROM weeks"),
    "j6_busy_gids": _weekly(f"SELECT gid AS GID, Account, weekNum, yearNum, {METRICS} FROM week_spend"),
    "j7_analytics_feed": _margined("SELECT Margin, Brand, date, itemQuantity, sku AS productSku, productName, itemRevenue "
                                   "FROM sold JOIN variants USING (sku)"),
    "j8_margin_cost_join": _margined("SELECT Margin, Brand, date, itemQuantity, sku AS productSku, productName, itemRevenue, Cost "
                                     "FROM sold JOIN variants USING (sku) JOIN day_cost USING (date, sku)"),
    "j9_size_join": _sized("SELECT date, size, itemRevenue, itemQuantity, round(Cost, 6) AS Cost "
                            "FROM size_units JOIN size_cost USING (date, size)"),
    "j10_min_pop_semi": _stored(f"SELECT {DS_COLS} FROM ds SEMI JOIN {FIRST_RANKS} USING (Pop)"),
    "j11_view_x_join": _stored(f"SELECT {DS_COLS} FROM ds WHERE ID IN (SELECT ID FROM ds SEMI JOIN {FIRST_RANKS} USING (Pop))"),
    "j12_currency": with_standins(RATES + f"\nSELECT Date, GID, OfferID, Cost, "
                                  f"round(CAST(Cost AS DOUBLE) / 1000000 / {USD} * {GBP}, 6) AS newCost FROM ads"),
    # ------------------------------------------------------- aggregations
    "a1_monthly_ads": _selling(f"SELECT sku AS GID, 'ACCOUNT US' AS Account, mon AS monthNum, yr AS yearNum, {METRICS} FROM spend"),
    "a2_monthly_analytics": _selling("SELECT country, productSku, productName, mon AS monthNum, yr AS yearNum, itemRev AS itemRevenue, "
                                     "round(rate, 6) AS buyToDetailRate FROM demand"),
    "a3_distinct_pop_gid": _selling("SELECT Pop, sku AS GID FROM ranks SEMI JOIN spend USING (sku)"),
    "a4_match_dedup": _selling(f"SELECT sku AS GID, {METRICS}, IMG, mon AS monthNum, yr AS yearNum, Pop, BRAND "
                               "FROM spend JOIN looks USING (sku) JOIN ranks USING (sku)"),
    "a5_match_totals": _selling(f"SELECT sku AS GID, mon AS monthNum, yr AS yearNum, {METRICS}, IMG, BRAND, Pop "
                                "FROM looks JOIN ranks USING (sku) JOIN spend USING (sku)"),
    "a6_clicks_per_gid": _plain("SELECT regexp_replace(GID, ' .*$', '') AS GID, CAST(SUM(Clicks) AS BIGINT) AS Clicks "
                                "FROM ads GROUP BY 1"),
    "a7_weekly_ads": _plain(
        "SELECT regexp_replace(GID, ' .*$', '') AS GID, Account, CAST(strftime(Date, '%W') AS INTEGER) + 1 AS weekNum, "
        "strftime(Date, '%Y') AS yearNum, CAST(SUM(Impressions) AS BIGINT) AS Impressions, "
        "CAST(SUM(Clicks) AS BIGINT) AS Clicks, CAST(SUM(Cost) AS BIGINT) AS Cost, "
        "round(SUM(ConversionValue), 6) AS ConversionValue FROM ads GROUP BY 1, 2, 3, 4"),
    "a8_weekly_analytics": _plain(
        "SELECT country, productSku, lower(productName) AS productName, "
        "CAST(strftime(strptime(date, '%Y%m%d'), '%W') AS INTEGER) + 1 AS weekNum, "
        "strftime(strptime(date, '%Y%m%d'), '%Y') AS yearNum, CAST(SUM(itemRevenue) AS BIGINT) AS itemRevenue, "
        "round(AVG(buyToDetailRate), 6) AS buyToDetailRate FROM analytics "
        f"WHERE {INT_DATE} AND country = 'United States' GROUP BY 1, 2, 3, 4, 5"),
    "a9_daily_ad_cost": _plain("SELECT Date, regexp_replace(GID, ' .*$', '') AS GID, CAST(SUM(Cost) AS BIGINT) AS Cost "
                               "FROM ads GROUP BY 1, 2"),
    "a10_distinct_margins": _plain("SELECT DISTINCT Margin, lower(GID) AS GID, BRAND AS Brand FROM feed"),
    "a11_margin_roas": _margined(_margin_report(f"(sum(Cost) / 1000000.0::DOUBLE / {USD} * {GBP})"), more=RATES + ","),
    "a12_size_analytics": _sized("FROM size_units"),
    "a13_size_ad_cost": _sized("SELECT date, size, round(Cost, 6) AS Cost FROM size_cost"),
    "a14_size_roas": _sized(_size_report(f"(Cost / {USD} * {GBP})"), more=RATES + ","),
    "a15_min_pop": _stored("SELECT DISTINCT ID, monthNum, yearNum, min(Pop) OVER (PARTITION BY ID, monthNum, yearNum) AS Pop FROM ds"),
    "a16_avg_pop_x": _stored(f"SELECT ID, round(avg(Pop) + 1e-9, 6) AS avg_pop FROM ds SEMI JOIN {FIRST_RANKS} USING (Pop) GROUP BY ID"),
    "a17_view_rollup": _stored(_rollup("monthNum", "Monthum", "round(avg(Clicks), 0)", "ds")),
    # ------------------------------------------------ window, order, union
    "w1_decline_rule": _weekly(f"SELECT {WEEK_COLS}, round(newCost, 6) AS newCost, round(newROAS, 6) AS newROAS "
                               f"FROM scored WHERE {_declined(0.75)}"),
    "o1_rank_order": _plain(f"SELECT {POP_COLS} FROM popular ORDER BY Pop, GTIN"),
    "o1_global_rank": "SELECT p_partkey, CAST(floor(p_retailprice / 500) AS INTEGER) AS price, "
                      "row_number() OVER (ORDER BY floor(p_retailprice / 500) DESC, p_partkey) AS Pop FROM part",
    "o2_top_n": _plain(f"SELECT {POP_COLS} FROM top2000"),
    "o3_output_order": _weekly(f"SELECT {WEEK_COLS} FROM weeks"),
    "u1_union_pulls": _plain(f"SELECT {AN_COLS} FROM analytics WHERE date IN ({REPORT_DAYS})"),
    "u1_latest_pull": _plain("""
SELECT if(Date < DATE '2024-01-08', '2024-01-15', '2024-01-29') AS pull, Date, GID, OfferID, Account, Impressions,
  if(Date < DATE '2024-01-08', 0, Clicks) AS Clicks, Cost, round(ConversionValue, 6) AS ConversionValue FROM ads"""),
    "u1_stream_ingest": _plain(f"SELECT {ADS_COLS} FROM ads"),
    # ------------------------------------------------------------ filters
    "p1_account_filter": _plain(f"SELECT {ADS_COLS} FROM ads WHERE Account = 'ACCOUNT US'"),
    "p2_not_in_inventory": _plain(UNSOLD.format("popular")),
    "p3_country_filter": _plain(f"SELECT {AN_COLS} FROM analytics WHERE country = 'United States'"),
    "p4_category_filter": _plain("SELECT date, productSku, size, itemRevenue, itemQuantity FROM analytics "
                                 "WHERE productType = 'Shoes'"),
    "p5_having_clicks": _plain("SELECT regexp_replace(GID, ' .*$', '') AS GID, CAST(SUM(Clicks) AS BIGINT) AS Clicks "
                               "FROM ads GROUP BY 1 HAVING SUM(Clicks) > 400"),
    "p6_integer_dates": _plain(f"SELECT {AN_COLS} FROM analytics WHERE {INT_DATE}"),
    "p7_drop_not_set": _plain(f"SELECT {AN_COLS} FROM analytics WHERE productName IS DISTINCT FROM '(not set)'"),
    "p8_drop_rename": _plain(f"SELECT {POP_COLS} FROM popular"),
    "p9_type_casts": _plain('SELECT Pop AS "Popularity rank", GTIN, Title FROM popular'),
    "p9_gtin_forms": with_standins(DIRTY + "\nSELECT src, p_partkey, GTIN FROM formed"),
    "j2_gtin_forms": with_standins(DIRTY + f"""
SELECT DISTINCT 'literal' AS rule, formed.p_partkey AS Pop, lower(feed.GID) AS GID
FROM feed JOIN formed ON {_key('feed.GTIN', 2)} = {_key('formed.GTIN', 4)}
UNION ALL SELECT DISTINCT 'clean', formed.p_partkey, lower(feed.GID)
FROM feed JOIN formed ON {_clean_key('feed.GTIN')} = {_clean_key('formed.GTIN')}"""),
    "p10_labels": _weekly(f"SELECT {WEEK_COLS}, '{WEEK_RANGE}' AS WeekRange FROM weeks"),
    "p11_fill_missing": _plain(
        "SELECT Date, OfferID, round(coalesce(SUM(ConversionValue) / nullif(CAST(SUM(Cost) AS DOUBLE) / 1000000, 0), "
        "-0.01), 6) AS ROAS, CAST(COUNT(*) AS DOUBLE) AS salesVolume FROM ads GROUP BY Date, OfferID"),
    "p12_ads_cost_projection": _plain("SELECT Date, OfferID, Cost FROM ads"),
    # --------------------------------------------------- scalar functions
    "f1_month_str": _plain("SELECT DISTINCT Date, strftime(Date, '%m') AS monthNum FROM ads"),
    "f2_year_str": _plain("SELECT DISTINCT Date, strftime(Date, '%Y') AS yearNum FROM ads"),
    "f3_week_number": _plain("SELECT DISTINCT Date, CAST(strftime(Date, '%W') AS INTEGER) + 1 AS weekNum FROM ads"),
    "f4_compact_to_iso": _plain("SELECT DISTINCT date, substr(date, 1, 4) || '-' || substr(date, 5, 2) || '-' "
                                "|| substr(date, 7, 2) AS iso FROM analytics"),
    "f5_reporting_week": _plain(f"SELECT date, COUNT(*) AS n_rows FROM analytics WHERE date IN ({REPORT_DAYS}) "
                                "GROUP BY date"),
    "f6_four_week_calendar": _plain(
        "SELECT CAST(strftime(Date, '%W') AS INTEGER) + 1 AS weekNum, COUNT(*) AS n_rows FROM ads "
        f"WHERE Date BETWEEN DATE '{DECLINE_START}' AND DATE '{DECLINE_END}' GROUP BY 1"),
    "f7_before_first_space": _plain("SELECT DISTINCT GID, regexp_replace(GID, ' .*$', '') AS gid_clean FROM ads"),
    "f8_lower_key": _plain("SELECT DISTINCT lower(regexp_replace(GID, ' .*$', '')) AS gid FROM ads"),
    "f9_offer_key": _plain(f"SELECT DISTINCT OfferID, {OFFER} AS offer FROM ads"),
    "f10_last_dash_token": _plain(f"SELECT DISTINCT OfferID, regexp_extract({OFFER}, '[^-]*$') AS token FROM ads"),
    "f11_clean_size": _plain(f"SELECT DISTINCT size, {CLEAN_SIZE} AS clean FROM analytics"),
    "f12_digits_and_dots": _plain(f"SELECT DISTINCT size, regexp_replace({CLEAN_SIZE}, {DIGITS}, '', 'g') AS digits "
                                  "FROM analytics"),
    "f13_new_sku": _plain(f"SELECT DISTINCT productSku, size, lower(productSku || '-' || {CLEAN_SIZE}) AS NEWSKU "
                          "FROM analytics"),
    "f14_gtin_key": _plain(
        f"SELECT 'feed' AS side, GTIN, {_key('GTIN', 2)} AS gtin_key, {_clean_key('GTIN')} AS clean_key FROM feed "
        f"UNION ALL SELECT 'ranking' AS side, GTIN, {_key('GTIN', 4)} AS gtin_key, {_clean_key('GTIN')} AS clean_key "
        "FROM popular"),
    "f15_micros_to_units": _plain("SELECT Date, OfferID, Cost, round(CAST(Cost AS DOUBLE) / 1000000, 6) AS units "
                                  "FROM ads"),
    "f16_roas": _plain("SELECT Date, OfferID, round(CASE WHEN CAST(Cost AS DOUBLE) / 1000000 <= 0 THEN 0.0 "
                       "ELSE ConversionValue / (CAST(Cost AS DOUBLE) / 1000000) END, 6) AS newROAS FROM ads"),
    "f17_lenient_numbers": _plain(
        f"SELECT date, productSku, round({_ld('size')}, 6) AS size_num, round({_ld(CLEAN_SIZE)}, 6) AS clean_num, "
        f"round({_ld(REV_TEXT)}, 6) AS rev_num, "
        f"{_lb(BTDR_TEXT)} AS btdr_int, "
        f"round({_ld('productName')}, 6) AS name_num FROM analytics"),
    "f18_btdr": _plain("SELECT DISTINCT buyToDetailRate, round(CAST(buyToDetailRate AS DOUBLE) / 100, 6) AS BTDR "
                       "FROM analytics"),
}
