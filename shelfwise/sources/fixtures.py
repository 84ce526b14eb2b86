"""Writers that render DataFrames in the raw input formats (feed XML, ad
report CSV, ranking CSV, analytics JSON responses).

They exist for round-trip checks: a table Spark derives from the test data
is written in the source format and read back by the readers, so the
readers are exercised on data that grows with the tables.  Rendering is
Spark's own writers and expressions per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from .ads import RANGE_COLUMNS, REPORT_COLUMNS
from .analytics import ANALYTICS_RENAMES
from .feed import FEED_FIELDS, MARGIN_FIELD

FEED_NAMESPACE = "http://base.google.com/ns/1.0"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint location the cluster names
    (never a machine-local temp folder), gone after the run."""
    return scratch_folder(spark, label)


def write_feed_xml(feed: DataFrame, path: str, margin_field: str = MARGIN_FIELD) -> None:
    """Feed rows (GID, ID, GTIN, IMG, BRAND, Margin, Size) as RSS items."""
    columns = {**{v: k for k, v in FEED_FIELDS.items()}, "Margin": margin_field}
    items = feed.select(*[F.col(c).alias(element) for c, element in columns.items() if c in feed.columns])
    (items.write.mode("overwrite").format("xml").option("rowTag", "item")
     .option("rootTag", f'channel xmlns:g="{FEED_NAMESPACE}"')
     .option("validateName", "false").save(path))                # names carry the namespace prefix


def write_ads_report(ads: DataFrame, path: str, with_offer: bool = True,
                     title: str = "Shopping - Product Titles - 7 days",
                     header: Sequence[str] | None = None) -> None:
    """Ad rows as report CSV files: a title line, the header, then rows.  The
    first row of each part file carries the two lines in front of it.
    ``header`` sets another column order."""
    header = list(header or (REPORT_COLUMNS if with_offer else RANGE_COLUMNS))
    source = {"Day": "Date", "Item Id": "OfferID", "Product type (1st level)": "GID",
              "Impressions": "Impressions", "Clicks": "Clicks", "Cost": "Cost",
              "Account": "Account", "Total conv. value": "ConversionValue"}
    row = F.to_csv(F.struct(*[F.col(source[h]).cast("string").alias(h) for h in header]))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = ads.select(F.when(first, F.concat(F.lit(f"{title}\n{','.join(header)}\n"), row)).otherwise(row))
    lines.write.mode("append").text(path)


def write_ranking_csv(raw: DataFrame, path: str) -> None:
    """Ranking rows (report column names) as CSV with a header line."""
    raw.write.mode("overwrite").option("header", "true").csv(path)


def write_analytics_responses(report: DataFrame, path: str, dimensions: Sequence[str],
                              metrics: Sequence[str], page_rows: int = 500) -> None:
    """Analytics rows as report responses, one JSON document per line.
    Rows are paged by their position in the partition (at most
    ``page_rows`` per document), so no document grows with the table."""
    to_api = {v: k for k, v in ANALYTICS_RENAMES.items()}
    row = F.struct(
        F.array(*[F.col(d).cast("string") for d in dimensions]).alias("dimensions"),
        F.array(F.struct(F.array(*[F.col(m).cast("string") for m in metrics]).alias("values"))).alias("metrics"),
    )
    header = F.struct(
        F.array(*[F.lit(to_api[d]) for d in dimensions]).alias("dimensions"),
        F.struct(F.array(*[F.struct(F.lit(to_api[m]).alias("name"), F.lit("STRING").alias("type"))
                           for m in metrics]).alias("metricHeaderEntries")).alias("metricHeader"),
    )
    page = F.floor(F.monotonically_increasing_id() / page_rows)
    docs = report.groupBy(page.alias("_page")).agg(F.collect_list(row).alias("rows"))
    docs = docs.select(F.array(F.struct(header.alias("columnHeader"),
                                        F.struct(F.col("rows")).alias("data"))).alias("reports"))
    docs.write.mode("overwrite").json(path)
