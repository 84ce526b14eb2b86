"""Quality rules whose thresholds adapt to each language and source.

One pass takes counts from every whole text.  Ratios of these counts go into
mergeable quantile sketches: histograms over logarithmic buckets, kept as one
row per language, source, ratio and bucket, so that partial sketches merge by
adding counts.  Quartiles read from the sketches give each language and source
its own fences, and documents are filtered by joining them with their fences.  Where
a ratio is nearly always zero, the upper fence follows the sketch's 95 % quantile
and the text's own size, so that one repeat in a short text stays.

Sources with few documents use the merged sketch of their language, and
languages with few documents the merged sketch of all."""

from __future__ import annotations

from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, python_workers, whole_row

#: Relative error of a sketch's quantiles.
ACCURACY = 0.01
_STEP = log((1 + ACCURACY) / (1 - ACCURACY))
#: Sketches of fewer documents give way to the merged sketch of the next level.
MIN_DOCS = 200
#: Fences lie this many spreads beyond the quartiles.
REACH = 4.0

#: Characters that count as symbols, and ASCII white space between words.
_SYMBOLS = b"#*$%&|<>"

#: Ratios: name, the most that the least spread may be (for ratios that are
#: nearly always equal) and whether low values are fenced too.
RATIOS = (("symbols_per_word", 0.05, False), ("repeat_share", 0.12, False),
          ("dup_line_share", 0.1, False), ("upper_share", 0.04, False),
          ("chars_per_word", 0.5, True))

#: The least spread of these is read from the sketch (95 % quantile less upper
#: quartile), but is at least one event of so many in the text's own count: a
#: symbol, two windows of three words, a line, a word in capitals.
EVENTS = {"symbols_per_word": (1, "n_words"), "repeat_share": (6, "n_words"),
          "dup_line_share": (1, "n_lines"), "upper_share": (6, "word_chars")}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """The counts of one text, in the order of the result's fields."""
    if not text:
        return 0, 0, 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    inside = b"".join(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    upper = len(inside) - len(inside.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (len(words), len(text) - (len(data) - len(inside)),
            len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
            _repeat_words(words), len(lines), upper)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds at least twice."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([number[w] for w in words], np.int64)
    n = len(number)
    pairs = ids[:-2] * n + ids[1:-1]
    if n >= 1 << 21:                                  # three numbers would not fit in one
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * n + ids[2:]
    order = np.sort(windows)
    again = order[1:] == order[:-1]
    if not again.any():
        return 0
    repeated = np.isin(windows, order[1:][again])
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= repeated
    return int(covered.sum())


def counts_of(text: Column) -> Column:
    """A struct of the counts of each text."""
    @F.pandas_udf(", ".join(f"{name} long" for name in _COUNTS))
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t) for t in texts], columns=list(_COUNTS))

    return count(text)


def base_failed(c: Column) -> Column:
    """The fixed base rule: under 50 words, or over half of them repeated."""
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def _ratios(c: Column) -> dict[str, Column]:
    words = F.greatest(c["n_words"], F.lit(1))
    return {"symbols_per_word": c["n_symbols"] / words, "repeat_share": c["n_repeat_words"] / words,
            "dup_line_share": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
            "upper_share": c["n_upper"] / F.greatest(c["word_chars"], F.lit(1)),
            "chars_per_word": c["word_chars"] / words}


def sketches(counts: DataFrame) -> DataFrame:
    """One row per lang, source, ratio and bucket with the number of documents.
    Bucket null holds the zeros.  ``counts`` has lang, source and the struct
    ``c``; rows that fail the base rule are left out."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("ratio"), value.alias("value"))
                               for name, value in _ratios(F.col("c")).items()])).alias("_r")
    bucket = F.when(F.col("_r.value") > 0, F.ceil(F.log("_r.value") / _STEP))
    return (counts.filter(~base_failed(F.col("c"))).select("lang", "source", each)
            .groupBy("lang", "source", F.col("_r.ratio").alias("ratio"), bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, keys: list[str], levels: dict[str, float]) -> DataFrame:
    """Quantiles of merged sketches: one row per ``keys``, with the number of
    documents ``docs``.  A value has the relative error ``ACCURACY``."""
    merged = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    all_rows = Window.partitionBy(*keys)
    upto = all_rows.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(2 * F.exp(F.col("bucket") * _STEP) / (1 + F.exp(F.lit(_STEP))), F.lit(0.0))
    ranked = merged.select(*keys, value.alias("_v"), F.sum("n").over(upto).alias("_upto"),
                           F.sum("n").over(all_rows).alias("docs"))
    return ranked.groupBy(*keys).agg(
        F.first("docs").alias("docs"),
        *[F.min(F.when(F.col("_upto") >= q * F.col("docs"), F.col("_v"))).alias(name)
          for name, q in levels.items()])


def fences(sketch: DataFrame, min_docs: int = MIN_DOCS, reach: float = REACH) -> DataFrame:
    """``lang``, ``source`` and the map ``fence`` from ratio to its bounds, for
    every language and source in ``sketch``.  A value may be from ``low`` to
    ``high``, or to ``each`` events of its text over ``base`` where that is more,
    but not over ``most``."""
    levels = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "q95": 0.95}
    own = quantiles(sketch, ["lang", "source", "ratio"], levels)
    by_lang = quantiles(sketch, ["lang", "ratio"], levels)
    overall = quantiles(sketch, ["ratio"], levels)
    pick = ["docs", *levels]
    packed = lambda df, keys, name: df.select(*keys, F.struct(*pick).alias(name))
    rows = (packed(own, ["lang", "source", "ratio"], "own").alias("o")
            .join(packed(by_lang, ["lang", "ratio"], "mid").alias("l"),
                  F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.ratio") == F.col("l.ratio")))
            .join(packed(overall, ["ratio"], "top").alias("t"), F.col("o.ratio") == F.col("t.ratio"))
            .select("o.lang", "o.source", "o.ratio",
                    F.when(F.col("own.docs") >= min_docs, F.col("own"))
                    .when(F.col("mid.docs") >= min_docs, F.col("mid")).otherwise(F.col("top")).alias("q")))
    least, low_too = F.lit(None).cast("double"), F.lit(False)
    for name, spread, both in RATIOS:
        least = F.when(F.col("ratio") == name, F.lit(spread)).otherwise(least)
        low_too = F.when(F.col("ratio") == name, F.lit(both)).otherwise(low_too)
    spread = F.greatest(F.col("q.q3") - F.col("q.q1"), least) * reach
    derived = F.greatest(F.col("q.q3") - F.col("q.q1"), F.least(F.col("q.q95") - F.col("q.q3"), least)) * reach
    counted = F.col("ratio").isin(*EVENTS)
    bounds = F.struct(F.when(low_too, F.col("q.q1") - spread).alias("low"),
                      (F.col("q.q3") + F.when(counted, derived).otherwise(spread)).alias("high"),
                      F.col("q.q3").alias("base"), F.lit(float(reach)).alias("each"),
                      (F.col("q.q3") + spread).alias("most"))
    return (rows.select("lang", "source", F.struct("ratio", bounds.alias("bounds")).alias("_b"))
            .groupBy("lang", "source").agg(F.map_from_entries(F.collect_list("_b")).alias("fence")))


def with_verdict(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``base_failed``, ``failed_ratio`` (the first ratio outside its
    fence, or null) and ``kept`` to ``rows`` (lang, source and ``c``).  The
    fences, one row per language and source, are counted and sent to the rows
    while they are few."""
    limits = cut(limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                               F.col("fence").alias("_fence")))
    joined = rows.join(broadcast_if_small(limits, limits.count()), F.col("lang").eqNullSafe(F.col("_lang"))
                       & F.col("source").eqNullSafe(F.col("_source")), "left")
    failed = F.lit(None).cast("string")
    for name, value in reversed(_ratios(F.col("c")).items()):
        bound = F.col("_fence")[name]
        high = bound["high"]
        if name in EVENTS:
            size, of = EVENTS[name]
            event = F.lit(size) / F.greatest(F.col("c")[of], F.lit(1))
            high = F.greatest(high, F.least(bound["base"] + bound["each"] * event, bound["most"]))
        outside = (value > high) | F.coalesce(value < bound["low"], F.lit(False))
        failed = F.when(outside, F.lit(name)).otherwise(failed)
    failed_base = base_failed(F.col("c"))
    return (joined.withColumn("base_failed", failed_base).withColumn("failed_ratio", failed)
            .withColumn("kept", ~failed_base & F.col("failed_ratio").isNull())
            .drop("_lang", "_source", "_fence"))


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, reach: float = REACH) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, failed_ratio and kept for
    every row of ``docs`` (doc_id, text, lang, source).

    Null and empty texts have no words, so they fail the base rule.  Null
    languages and sources are groups of their own; repeated rows count as often
    as they stand; an empty table gives no rows; other columns are not read.
    The counts are taken once and written to the checkpoint folder."""
    python_workers(docs.sparkSession)
    counted = cut(docs.select("doc_id", "lang", "source", counts_of(F.col("text")).alias("c")))
    return (with_verdict(counted, fences(sketches(counted), min_docs, reach))
            .select("doc_id", "lang", "source", "c.*", "base_failed", "failed_ratio", "kept"))


def keep_good(docs: DataFrame, min_docs: int = MIN_DOCS, reach: float = REACH) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.  The texts are
    read twice (once for the sketches, once to filter) and not shuffled while
    the fences are few."""
    python_workers(docs.sparkSession)
    counted = docs.select("lang", "source", counts_of(F.col("text")).alias("c"))
    limits = fences(sketches(counted), min_docs, reach)
    whole = docs.select(whole_row(docs).alias("_doc"), "lang", "source",
                        counts_of(F.col("text")).alias("c"))
    return with_verdict(whole, limits).filter("kept").select("_doc.*")
