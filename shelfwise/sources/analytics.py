"""Web-analytics product reports.

S6/S7 read saved API responses (nested JSON) into the flat report the
pipelines use.  S8-S11 compute the same daily product report directly from
a raw hit/event table -- the Spark-side equivalent of the remote report
request: grouping, distinct counts and the rate, plus the user segment and
traffic-source filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Report field names and their column names in the pipelines.
ANALYTICS_RENAMES = {
    "ga:date": "date",
    "ga:productName": "productName",
    "ga:productSku": "productSku",
    "ga:itemRevenue": "itemRevenue",
    "ga:buyToDetailRate": "buyToDetailRate",
    "ga:country": "country",
    "ga:quantityAddedToCart": "quantityAddedToCart",
    "ga:itemQuantity": "itemQuantity",
    "ga:uniquePurchases": "uniquePurchases",
    "ga:dimensionX": "size",
    "ga:productCategoryLevelX": "productType",
}
PRODUCT_DIMENSIONS = ("date", "productName", "productSku", "country")
SIZE_DIMENSIONS = PRODUCT_DIMENSIONS + ("size", "productType")
SEGMENT = "segment"
CPC = "google / cpc"

RESPONSE_SCHEMA = StructType([StructField("reports", ArrayType(StructType([
    StructField("columnHeader", StructType([
        StructField("dimensions", ArrayType(StringType())),
        StructField("metricHeader", StructType([
            StructField("metricHeaderEntries", ArrayType(StructType([
                StructField("name", StringType()), StructField("type", StringType())])))])),
    ])),
    StructField("data", StructType([
        StructField("rows", ArrayType(StructType([
            StructField("dimensions", ArrayType(StringType())),
            StructField("metrics", ArrayType(StructType([
                StructField("values", ArrayType(StringType()))]))),
        ]))),
    ])),
])))])


def read_documents(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """Saved report responses as text: column ``value``, one JSON document per
    line (or one per file with ``multi_line``); blank lines are no documents."""
    lines = spark.read.text(path if isinstance(path, str) else list(path), wholetext=multi_line)
    return lines.filter(F.trim("value") != "")


def _parsed(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``value`` and ``reports`` (and ``keep``); a document that does not parse, or has no
    list of reports, has null ``reports``."""
    schema = StructType([*RESPONSE_SCHEMA.fields, StructField("_corrupt_record", StringType())])
    parsed = documents.select("value", *keep, F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("_d"))
    return parsed.select("value", *keep, F.when(F.col("_d._corrupt_record").isNull(), F.col("_d.reports")).alias("reports"))


def read_lines(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """S6 input from document texts (column ``value``).  A bad document stops
    the read with an error that shows its beginning.  Columns named in ``keep``
    go along."""
    shown = F.concat(F.lit("bad analytics document: "), F.left("value", F.lit(200)))
    return _parsed(documents.filter(F.trim("value") != ""), keep).select(
        *keep, F.when(F.col("reports").isNull(), F.raise_error(shown)).otherwise(F.col("reports")).alias("reports"))


def read_responses(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False,
                   divert_to: str | None = None) -> DataFrame:
    """S6 input: saved report responses.  Many files / days are one read.

    A document that does not parse or has no reports stops the read.  With
    ``divert_to`` such documents are appended as text to that folder instead,
    and the others are returned."""
    documents = read_documents(spark, path, multi_line)
    if divert_to is None:
        return read_lines(documents)
    parsed = _parsed(documents)
    parsed.filter(F.col("reports").isNull()).select("value").write.mode("append").text(divert_to)
    return parsed.filter(F.col("reports").isNotNull()).select("reports")


def flatten_responses(responses: DataFrame, fields: Sequence[str], keep: Sequence[str] = (),
                      others: str | None = None) -> DataFrame:
    """Reports -> rows -> one column per header name.

    Every report is kept (not only the last) and values stay whole even
    when they contain commas; the header of each report names its values,
    looked up by position.  ``fields`` lists the header names to project
    (all text); a name missing from a report, or a short row, gives NULL.
    Columns of ``responses`` named in ``keep`` go along.

    ``others`` names a VARIANT column for everything that ``fields`` does not
    list: an object from header name to text, NULL where a report has no other
    name.  So no reported value is lost, and ``other_field`` reads a name that
    was unknown when the table was written.  Of a repeated name the first value
    counts; a name without a value in a short row is left out.
    """
    reports = responses.select(*keep, F.explode("reports").alias("r"))
    rows = reports.select(
        *keep,
        F.concat(F.coalesce(F.col("r.columnHeader.dimensions"), F.array().cast("array<string>")),
                 F.transform(F.coalesce(F.col("r.columnHeader.metricHeader.metricHeaderEntries"),
                                        F.array().cast("array<struct<name:string,type:string>>")),
                             lambda m: m["name"])).alias("names"),
        F.explode("r.data.rows").alias("row"),
    )
    values = F.concat(F.coalesce(F.col("row.dimensions"), F.array().cast("array<string>")),
                      F.flatten(F.transform(F.coalesce(F.col("row.metrics"),
                                                       F.array().cast("array<struct<values:array<string>>>")),
                                            lambda m: m["values"])))
    flat = rows.select(*keep, "names", values.alias("vals"))

    def field(name: str):
        # position of the header name (first occurrence); a row with fewer
        # values than names yields NULL instead of failing the whole read
        pos = F.array_position("names", F.lit(name)).cast("int")
        return F.when(pos > 0, F.try_element_at("vals", pos)).alias(name)

    columns = [*keep, *[field(f) for f in fields]]
    if others is not None:
        places = F.filter(F.sequence(F.lit(1), F.greatest(F.size("names"), F.lit(1))), lambda i: (
            (i <= F.size("vals")) & ~F.try_element_at("names", i).isin(*fields)
            & (F.array_position("names", F.try_element_at("names", i)) == i)))
        rest = F.map_from_entries(F.transform(places, lambda i: F.struct(
            F.try_element_at("names", i).alias("k"), F.try_element_at("vals", i).alias("v"))))
        columns.append(F.when(F.size(places) > 0, F.to_variant_object(rest)).alias(others))
    return flat.select(*columns)


def other_field(name: str, column: str = "others") -> Column:
    """A reported value that ``flatten_responses(others=...)`` kept, as text;
    NULL where the report had no such name."""
    if '"' in name:                                   # extraction paths have no escapes
        return F.try_element_at(F.col(column).cast("map<string,string>"), F.lit(name))
    return F.try_variant_get(F.col(column), f'$["{name}"]', "string")


def rename_fields(report: DataFrame, renames: Mapping[str, str] = ANALYTICS_RENAMES) -> DataFrame:
    """Report field names -> pipeline column names (mapping is a parameter)."""
    present = {k: v for k, v in renames.items() if k in report.columns}
    return report.withColumnsRenamed(present)


# ------------------------------------------------------ S8-S11 over raw hits

def _is(kind: str):
    return F.col("event_type") == kind


def product_report(hits: DataFrame, dims: Sequence[str] = PRODUCT_DIMENSIONS) -> DataFrame:
    """The daily product report per ``dims``.

    itemRevenue and itemQuantity sum purchases, uniquePurchases counts the
    distinct purchasing users, quantityAddedToCart counts cart adds (clicks)
    and buyToDetailRate is unique purchases per product detail view, x100
    (NULL when there was no detail view)."""
    report = hits.groupBy(*dims).agg(
        F.sum(F.when(_is("purchase"), F.col("cents")).otherwise(0)).alias("itemRevenue"),
        F.sum(F.when(_is("purchase"), F.col("quantity")).otherwise(0)).alias("itemQuantity"),
        F.count_distinct(F.when(_is("purchase"), F.col("user_id"))).alias("uniquePurchases"),
        F.sum(F.when(_is("click"), 1).otherwise(0)).cast("bigint").alias("quantityAddedToCart"),
        F.sum(F.when(_is("view"), 1).otherwise(0)).cast("bigint").alias("_views"),
    )
    rate = F.try_divide(F.col("uniquePurchases").cast("double"), F.col("_views").cast("double")) * 100
    return report.withColumn("buyToDetailRate", rate).drop("_views")


def size_report(hits: DataFrame) -> DataFrame:
    """S8 with size and category dimensions."""
    return product_report(hits, SIZE_DIMENSIONS)


def segment_report(hits: DataFrame, dims: Sequence[str] = PRODUCT_DIMENSIONS, column: str = "country",
                   value: str = "United States", where: Column | None = None, name: str | None = None) -> DataFrame:
    """S8 / S9 with S10, and S11 in the same request: the report of a user
    segment, with the segment's ``name`` (by default ``value``) in the
    ``segment`` dimension.

    The segment is user-scoped: all users with a hit of ``column == value``,
    whatever its source.  ``where`` (such as ``from_source()``) limits the hits
    that the report counts, not those that make a user a member, so a member
    whose matching hit came otherwise stays.

    One pass: hits are summed per user and dimensions, the measures over the
    hits of ``where`` beside a flag of all; a maximum per user over these
    partial rows settles membership, so the shuffle on the user carries one row
    per user and report row and not every hit.  A report row's distinct buyers
    are its partial rows with a purchase.  One user's partial rows meet in one
    task, where they may spill."""
    counted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    when = lambda kind, v: F.when(_is(kind) & counted, v)
    per_user = hits.groupBy("user_id", *dims).agg(
        F.max(F.coalesce(F.col(column) == value, F.lit(False))).alias("_match"), F.max(counted).alias("_counted"),
        F.sum(when("purchase", F.col("cents")).otherwise(0)).alias("itemRevenue"),
        F.sum(when("purchase", F.col("quantity")).otherwise(0)).alias("itemQuantity"),
        F.max(when("purchase", 1).otherwise(0)).alias("_bought"),
        F.sum(when("click", 1).otherwise(0)).cast("bigint").alias("quantityAddedToCart"),
        F.sum(when("view", 1).otherwise(0)).cast("bigint").alias("_views"))
    member = F.max("_match").over(Window.partitionBy("user_id"))
    # a null user is nobody: no join would match it either
    inside = per_user.withColumn("_member", member).filter(F.col("_member") & F.col("_counted") & F.col("user_id").isNotNull())
    report = inside.groupBy(*dims).agg(
        F.sum("itemRevenue").alias("itemRevenue"), F.sum("itemQuantity").alias("itemQuantity"),
        F.sum("_bought").cast("bigint").alias("uniquePurchases"),
        F.sum("quantityAddedToCart").alias("quantityAddedToCart"), F.sum("_views").alias("_views"))
    rate = F.try_divide(F.col("uniquePurchases").cast("double"), F.col("_views").cast("double")) * 100
    return report.withColumns({"buyToDetailRate": rate, SEGMENT: F.lit(value if name is None else name)}).drop("_views")


def user_segment(hits: DataFrame, column: str = "country", value: str = "United States") -> DataFrame:
    """S10 as hits: a user-scoped segment -- every hit of each user who has at
    least one hit matching ``column == value`` (not only the matching hits).
    For a report over the segment, ``segment_report`` shuffles less."""
    users = hits.filter(F.col(column) == value).select("user_id").distinct()
    return hits.join(users, "user_id", "left_semi")


def from_source(source_medium: str = CPC) -> Column:
    """S11 as a condition on hits, for ``segment_report(where=...)``."""
    return F.col("sourceMedium") == source_medium


def traffic_source(hits: DataFrame, source_medium: str = CPC) -> DataFrame:
    """Hits of one source / medium."""
    return hits.filter(from_source(source_medium))


# ------------------------------------------------ S8: distinct buyers over days

def daily_buyers(hits: DataFrame, dims: Sequence[str] = ("productName", "productSku", "country"), day: str = "date") -> DataFrame:
    """S8 buyers in a form that merges: per ``day``, ``dims`` and block of user
    numbers an exact bitmap of the users with a purchase (``buyers``).

    Users are their integer ``user_id``; ``dense_users`` numbers others.  A
    bitmap is 4 KiB for 32,768 users, so dense numbers keep few blocks.  Null
    users are not counted."""
    bought = hits.filter(_is("purchase") & F.col("user_id").isNotNull())
    return (bought.groupBy(day, *dims, F.bitmap_bucket_number("user_id").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("buyers")))


def buyers_over_days(daily: DataFrame, keys: Sequence) -> DataFrame:
    """Distinct buyers per ``keys`` (columns or expressions, such as a week of
    the day) from stored ``daily_buyers`` rows alone: equal to counting the
    distinct users of the raw hits.  Bitmaps are united map-side before the
    shuffle."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    united = daily.groupBy(*keys, "block").agg(F.bitmap_or_agg("buyers").alias("buyers"))
    names = [c for c in united.columns if c not in ("block", "buyers")]
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("buyers")).alias("uniquePurchases"))


def dense_users(hits: DataFrame, numbers: DataFrame | None = None, user: str = "client_id") -> DataFrame:
    """user and number of every distinct ``user`` of ``hits``: the known ones
    keep their number of ``numbers`` (a table this function made before), new
    ones follow after the largest.  Numbers are dense but for the gaps between
    the tasks that dealt them out."""
    new = hits.select(F.col(user).alias("user")).filter(F.col("user").isNotNull()).distinct()
    if numbers is None:
        return _numbered(new, 0)
    top = numbers.agg(F.max("number")).first()[0]
    return numbers.select("user", "number").unionByName(
        _numbered(new.join(numbers, "user", "left_anti"), 0 if top is None else top + 1))


def _numbered(users: DataFrame, start: int) -> DataFrame:
    """Users dealt into ranges by their hash, each range numbered by itself;
    the offsets are the counts of the ranges before."""
    block = F.pmod(F.xxhash64("user"), F.lit(1024)).alias("_block")
    rows = users.withColumn("_block", block)
    counts = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy("user")) - 1
    return (rows.withColumn("_place", place).join(F.broadcast(offsets), "_block")
            .select("user", (F.lit(start) + F.col("_off") + F.col("_place")).cast("bigint").alias("number")))
