"""Exact histogram of encoded lengths, and suffix sums over it.

Documents are aggregated by their number of tokens, so everything after the
first pass works on one row per distinct length.  Suffix sums over that table
answer, for every context limit, how many documents and tokens there are, which
quantile a length stands for and how many tokens truncation keeps."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, python_workers
from .encoding import VOCABULARY, encoder

#: Distinct lengths that one task sums up at once.
BLOCK = 256


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every document; null and empty texts
    have none."""
    python_workers(docs.sparkSession)

    @F.pandas_udf("long")
    def count(text: pd.Series) -> pd.Series:
        encode = encoder(vocabulary).ids
        return pd.Series([len(encode(t)) for t in text], dtype="int64")

    return docs.select("doc_id", count(F.col("text")).alias("n_tokens"))


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``n_tokens`` and ``n_docs``: how many documents have each length."""
    return (token_lengths(docs, vocabulary).groupBy("n_tokens")
            .agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per distinct length L of ``histogram``:

    * ``n_docs``, ``tokens``: documents of exactly L tokens and their tokens;
    * ``docs_from``, ``tokens_from``: documents of L or more tokens;
    * ``total_docs``, ``total_tokens``: of the whole table;
    * ``docs_upto`` and ``quantile``: documents of at most L tokens, and
      their share;
    * ``truncated_tokens``: tokens kept when every document is cut at L.

    Sums run over blocks of lengths first and then within each block, so that
    no task gets all lengths.  The histogram is used twice, so it is written to
    the checkpoint folder and the texts are encoded once.  An empty table gives
    no rows."""
    h = cut(histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                             F.floor(F.col("n_tokens") / BLOCK).alias("block")))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(everything).alias("total_docs"),
        F.sum("t").over(everything).alias("total_tokens"))
    here = (Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (h.join(blocks, "block")
           .withColumn("docs_from", F.sum("n_docs").over(here) + F.col("docs_after"))
           .withColumn("tokens_from", F.sum("tokens").over(here) + F.col("tokens_after")))
    upto = F.col("total_docs") - F.col("docs_from") + F.col("n_docs")
    kept = F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return out.select("n_tokens", "n_docs", "tokens", "docs_from", "tokens_from", "total_docs",
                      "total_tokens", upto.alias("docs_upto"),
                      (upto / F.col("total_docs")).alias("quantile"),
                      kept.alias("truncated_tokens"))


def at_limits(sums: DataFrame, limits: Iterable[int]) -> DataFrame:
    """``context_limit``, ``docs_over`` (documents longer than it) and
    ``truncated_tokens`` for each of ``limits``, from ``suffix_sums``.  The
    answer for a limit follows from the shortest length above it."""
    wanted = sorted({int(x) for x in limits})
    if not wanted:
        raise ValueError("no context limit given")
    at = F.array(*[F.lit(x).cast("long") for x in wanted])
    first = (sums.select(F.explode(at).alias("context_limit"), "*")
             .groupBy("context_limit")
             .agg(F.min(F.when(F.col("n_tokens") > F.col("context_limit"),
                               F.struct("n_tokens", "docs_from", "tokens_from"))).alias("over"),
                  F.max("total_tokens").alias("total_tokens")))
    docs_over = F.coalesce(F.col("over.docs_from"), F.lit(0))
    return first.select("context_limit", docs_over.alias("docs_over"),
                        (F.col("total_tokens") - F.coalesce(F.col("over.tokens_from"), F.lit(0))
                         + F.col("context_limit") * docs_over).alias("truncated_tokens"))


def quantile_lengths(sums: DataFrame, quantiles: Iterable[float]) -> DataFrame:
    """``quantile`` and ``n_tokens``: the smallest length that at least this
    share of the documents does not exceed."""
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    return (sums.select(F.explode(wanted).alias("wanted"), "quantile", "n_tokens")
            .filter(F.col("quantile") >= F.col("wanted"))
            .groupBy(F.col("wanted").alias("quantile")).agg(F.min("n_tokens").alias("n_tokens")))
