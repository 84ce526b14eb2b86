"""From raw documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.

1. ``quality``: documents that fail the base rule or lie outside their language
   and source's fences go.
2. ``near_dedup``: of each class of near-duplicates the smallest doc_id stays.
3. ``decontamination``: documents that share a window with a benchmark item go.
4. ``secrets``: secrets are masked in the texts (and n_chars follows).
5. ``packing``: token windows, one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import table
from shelfwise.llm.decontamination import drop_contaminated
from shelfwise.llm.near_dups import one_of_each
from shelfwise.llm.packing import pack
from shelfwise.llm.quality import keep_good
from shelfwise.llm.secrets import redact_versions
from shelfwise.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null, empty and short texts fail the base rule and go; a null language or
    source is a group like any other; repeated rows stay or go together."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts stay; empty texts and repeated rows are copies, one stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts have no hit and stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No row goes; null texts stay null."""
    return redact_versions(docs, length="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null or empty text is its end id alone; a null doc_id stays null."""
    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "sequence_length")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]

#: SQL has neither the token ids nor the alignment.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  What a stage returns is written below
    the session's shared checkpoint folder and read again by the next."""
    folder = scratch_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
