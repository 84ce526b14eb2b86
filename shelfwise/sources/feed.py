"""The product feed (RSS XML, items in the ``g`` namespace)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Feed element names (namespace prefix g) and the column each
# projection calls them.
FEED_FIELDS = {
    "g:item_group_id": "GID",
    "g:id": "ID",
    "g:gtin": "GTIN",
    "g:image_link": "IMG",
    "g:brand": "BRAND",
    "g:size": "Size",
}
MARGIN_FIELD = "g:custom_label_X"
_BAD = "_bad_item"
SHAPES = {
    "default": ["GID", "ID", "GTIN", "IMG", "BRAND"],
    "margins": ["Margin", "GID", "Brand"],
    "decline": ["GID", "IMG", "Brand"],
    "size": ["Size", "ID"],
    "all": ["GID", "ID", "GTIN", "IMG", "BRAND", "Margin", "Size"],
}


def feed_schema(margin_field: str = MARGIN_FIELD) -> StructType:
    """Every field is text: inference would read g:gtin as a number and
    drop leading zeros."""
    names = [*FEED_FIELDS, margin_field]
    return StructType([StructField(n, StringType()) for n in names])


def item_texts(spark: SparkSession, path: str | Sequence[str], row_tag: str = "item") -> DataFrame:
    """The items of feed files, each as its own text: ``value`` from the start
    tag to the end tag, ``closed`` (false where the end tag is missing, in
    which case ``value`` runs to the next item or the file's end).

    Files are cut at the start tags, in parallel also within a large file, so
    an item cannot take its successor with it; what stands before the first
    item of a file is no item."""
    reader = spark.read.option("lineSep", f"<{row_tag}")
    parts = reader.text(path if isinstance(path, str) else list(path)).filter(F.col("value").rlike(r"^(\s[^<>]*)?/?>"))
    end = F.locate(f"</{row_tag}>", F.col("value"))
    empty = F.col("value").rlike(r"^(\s[^<>]*)?/>")
    text = F.when(empty, F.regexp_extract("value", r"^[^>]*>", 0)).when(
        end > 0, F.substring(F.col("value"), F.lit(1), end + len(row_tag) + 2)).otherwise(F.col("value"))
    return parts.select(F.concat(F.lit(f"<{row_tag}"), text).alias("value"), ((end > 0) | empty).alias("closed"))


def read_feed(spark: SparkSession, path: str | Sequence[str], shape: str = "default",
              margin_field: str = MARGIN_FIELD, row_tag: str = "item", divert_to: str | None = None) -> DataFrame:
    """One row per ``item``; ``shape`` picks the projection the caller needs
    (default, margins, decline, size), so only those fields are read.  A
    missing element is NULL (the row then drops out of inner joins).

    Every item is parsed by itself.  One that does not parse, or has no end
    tag, stops the read with an error that shows its beginning; with
    ``divert_to`` such items are appended as text to that folder instead, one
    JSON object (``value``) a line, and the others are returned: items are the
    rows plus the diverted."""
    element = {**{v: k for k, v in FEED_FIELDS.items()}, "Brand": "g:brand", "Margin": margin_field}
    schema = StructType([StructField(element[c], StringType()) for c in SHAPES[shape]] + [StructField(_BAD, StringType())])
    items = item_texts(spark, path, row_tag)
    parsed = items.select("value", "closed", F.from_xml("value", schema, {
        "columnNameOfCorruptRecord": _BAD, "mode": "PERMISSIVE", "rowTag": row_tag}).alias("_i"))
    bad = ~F.col("closed") | F.col("_i").isNull() | F.col(f"_i.{_BAD}").isNotNull()
    if divert_to is None:
        shown = F.concat(F.lit("bad feed item: "), F.left("value", F.lit(200)))
        good = parsed.filter(F.when(bad, F.raise_error(shown).cast("boolean")).otherwise(F.lit(True)))
    else:
        parsed.filter(bad).select("value").write.mode("append").json(divert_to)
        good = parsed.filter(~bad)
    return good.select(*[F.col(f"_i.`{element[c]}`").alias(c) for c in SHAPES[shape]])
