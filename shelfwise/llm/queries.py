"""Registered queries of the training-data operators: each applies one operator
with production parameters to its whole table and derives the result's columns
from the operator's output."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import conversations, digests, linear_threads
from .common import table
from .decontamination import contamination
from .language_id import identify
from .licenses import license_spans, verdicts
from .lm_scoring import labelled_good, score
from .near_dups import near_duplicates
from .oracles import ORACLES  # noqa: F401  registered beside the queries
from .packing import pack
from .periodic_runs import periodic_runs
from .quality import judge
from .secrets import RULES, empty_findings, empty_ledger, scan_versions
from .sharding import shard_documents
from .spelling import variants, word_counts
from .token_counts import length_histogram, suffix_sums


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    said = F.lit("\\### Assistant: </turn> ok")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    done = conversations(linear_threads(turns))
    conv_id = F.when(~F.col("leaf_id").startswith("none:"), F.substring_index("leaf_id", ":", 1).cast("long"))
    return (done.select(conv_id.alias("conv_id"), digests(F.col("formatted"), F.col("loss_starts"), F.col("loss_ends")).alias("_d"))
            .select("conv_id", "_d.*"))


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adaptive quality verdict on every document."""
    return judge(table(spark, sf_dir, "documents")).drop("lang", "source")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned with an empty ledger."""
    docs = table(spark, sf_dir, "documents")
    versions = docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    paths, _, _ = scan_versions(versions, empty_ledger(spark), empty_findings(spark))
    line = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return paths.select(F.col("path").alias("doc_id"), *[count(r.kind) for r in RULES],
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram of all documents with its suffix sums."""
    return suffix_sums(length_histogram(table(spark, sf_dir, "documents")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of the ids."""
    docs = table(spark, sf_dir, "documents")
    remainder = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)), F.lit(2))
    return (identify(docs, learn_from=remainder != 2)
            .select("doc_id", (~F.col("learn")).alias("held_out"), "lang_pred", "score"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cross-entropy difference between the documents labelled
    good and all others."""
    docs = labelled_good(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score(docs, F.col("is_target"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    shards = shard_documents(table(spark, sf_dir, "documents"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template spans of every document."""
    found = verdicts(license_spans(table(spark, sf_dir, "documents")))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select("doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
                        F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
                        joined(F.col("phrases.label")).alias("base_labels"), joined(F.col("labels")).alias("labels"), "score")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, a tenth of them made periodic."""
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    denser = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", nothing, lambda best, r: F.when(denser(best, r), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                                F.lit("\n"))), "")
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
                    F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where the words of every tenth document by
    the crc32 h of its id repeat from a place on: word i from a = g % n on
    becomes word a + (i - a) % p, with g = h div 10 and p = 1 + (n - a) div
    (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce((h % 10 == 0) & F.col("text").isNotNull(), F.lit(False))
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", words.alias("_w"), F.expr("crc32(cast(doc_id AS string)) div 10").alias("_g"))
    rows = rows.withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rows = rows.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) AS int)"))
    again = F.expr("concat(slice(_w, 1, _a), slice(flatten(array_repeat(slice(_w, _a + 1, _p),"
                   " cast(ceil((_n - _a) / _p) AS int))), 1, _n - _a))")
    return rows.select("doc_id", F.when(F.col("_n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some with a letter
    left out."""
    return variants(word_counts(table(spark, sf_dir, "documents"), change=letter_left_out))


def letter_left_out(doc_id) -> Callable[[str], str]:
    """For a document's words: where 97 divides the crc32 h of
    ``<doc_id>:<word>``, the word without its code point h % length."""
    if doc_id is None:
        return lambda word: word
    seed = zlib.crc32(f"{doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), seed)
        if h % 97:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1:]

    return change


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_near_dups": op2_near_dups,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_secrets": op5_secrets,
    "op6_token_counts": op6_token_counts,
    "op7_language": op7_language,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_licenses": op11_licenses,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling": op13_spelling,
}
