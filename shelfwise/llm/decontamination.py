"""Benchmark decontamination by winnowing.

A text's k-grams are hashed, and of every ``SPAN - GRAM + 1`` consecutive
k-grams, which together cover ``SPAN`` words, the smallest hash is kept.  Two
texts that share ``SPAN`` consecutive words keep the same hash there, so joining
the fingerprints of documents and benchmark finds every document with such a
shared span.  The hits are then extended: around each matching fingerprint the
whole window is compared, and the matching windows mark words and items.

Items of fewer than ``SPAN`` words are single windows of their own length, with
the hash of the whole item as fingerprint.

Only DataFrame functions run here.  Hashes of longer and longer grams come from
pairing an array of hashes with itself shifted, so a window of any length takes
a few passes over the array.  Texts are addressed by a 128-bit key; equal texts
are examined once."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, text_key, whole_row

#: Words that a shared span must have.
SPAN = 10
#: Words of a fingerprinted gram.
GRAM = 4
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, then runs of ASCII letters and
    digits and all non-ASCII characters.  Null has none."""
    plain = F.coalesce(text, F.lit(""))
    lowered = (F.when(F.octet_length(plain) == F.char_length(plain), F.lower(plain))
               .otherwise(F.translate(plain, ascii_uppercase, ascii_lowercase)))
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def _pair(a: Column, size_a: int, b: Column, size_b: int, shift: int,
          f: Callable[[Column, Column], Column], n: Column) -> Column:
    """f(a[i], b[i + shift]) for every i where both exist, where ``a`` has the
    windows of ``size_a`` words of ``n`` and ``b`` those of ``size_b``."""
    rows = F.greatest(n - max(size_a, shift + size_b) + 1, F.lit(0))
    return F.zip_with(F.slice(a, 1, rows), F.slice(b, shift + 1, rows), f)


class _Grams:
    """Adds columns with window values to a DataFrame that has ``_w`` (words)
    and ``_n`` (their number), each from columns made before."""

    def __init__(self, df: DataFrame):
        self.df = df

    def hashes(self, size: int, seed: int = 0) -> str:
        """Column of the hashes of all grams of ``size`` words."""
        name = f"_h{seed}_{size}"
        if name in self.df.columns:
            return name
        if size == 1:
            made = F.transform("_w", lambda w: F.xxhash64(w) if not seed else F.xxhash64(F.lit(seed), w))
        else:
            left = 1 << (size - 1).bit_length() - 1
            a, b = self.hashes(left, seed), self.hashes(size - left, seed)
            made = _pair(F.col(a), left, F.col(b), size - left, left,
                         lambda x, y: F.xxhash64(x, y), F.col("_n"))
        self.df = self.df.withColumn(name, made)
        return name

    def minima(self, gram: int, span: int) -> str:
        """Column of the smallest gram hash in every window of ``span`` words."""
        have, width = self.hashes(gram), 1
        while width < span - gram + 1:
            shift = min(width, span - gram + 1 - width)
            size = gram + width - 1
            name = f"_m{gram}_{width + shift}"
            self.df = self.df.withColumn(name, _pair(F.col(have), size, F.col(have), size, shift,
                                                     lambda x, y: F.least(x, y), F.col("_n")))
            have, width = name, width + shift
        return have


def _with_words(texts: DataFrame, *keep: str) -> DataFrame:
    return (texts.select(*keep, words(F.col("text")).alias("_w"))
            .select(*keep, "_w", F.size("_w").alias("_n")))


def _windows(texts: DataFrame, keep: list[str], shorts: list[int]) -> DataFrame:
    """keep, len, at, f, g1, g2: every window of ``SPAN`` words and of the
    ``shorts`` lengths, with its fingerprint and two hashes of all of it."""
    grams = _Grams(_with_words(texts, *keep))
    kinds = []
    for size in (SPAN, *shorts):
        f = grams.minima(GRAM, SPAN) if size == SPAN else grams.hashes(size)
        zipped = F.arrays_zip(F.col(f).alias("f"), F.col(grams.hashes(size)).alias("g1"),
                              F.col(grams.hashes(size, 1)).alias("g2"))
        kinds.append(F.transform(zipped, _labelled(size)))
    return grams.df.select(*keep, F.explode(F.concat(*kinds)).alias("_x")).select(*keep, "_x.*")


def _labelled(size: int) -> Callable[[Column, Column], Column]:
    """The rows of ``_windows`` from the zipped hashes of windows of ``size``."""
    return lambda x, i: F.struct(F.lit(size).alias("len"), i.alias("at"), x["f"].alias("f"),
                                 x["g1"].alias("g1"), x["g2"].alias("g2"))


def _fingerprints(texts: DataFrame, keep: list[str], shorts: list[int]) -> DataFrame:
    """keep, len and f: the distinct fingerprints of each text."""
    grams = _Grams(_with_words(texts, *keep))
    kinds = [F.struct(F.lit(size).alias("len"), F.array_distinct(
        F.col(grams.minima(GRAM, SPAN) if size == SPAN else grams.hashes(size))).alias("fs"))
        for size in (SPAN, *shorts)]
    return (grams.df.select(*keep, F.explode(F.array(*kinds)).alias("_k"))
            .select(*keep, "_k.len", F.explode("_k.fs").alias("f")))


def find_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The distinct contaminated texts: k1, k2 (their key), n_hit, and items,
    the sorted item_ids (strings) that have a window in the text.

    ``docs`` has text, ``benchmark`` item_id and text."""
    bench = benchmark.select("item_id", "text")
    sizes = _with_words(bench, "item_id").select("_n").filter(F.col("_n").between(1, SPAN - 1))
    shorts = sorted(r[0] for r in sizes.distinct().collect())      # at most SPAN - 1 numbers
    item_words = F.size(words(F.col("text")))
    windows = _windows(bench.withColumn("_size", item_words), ["item_id", "_size"], shorts)
    windows = cut(windows.filter((F.col("len") == SPAN) | (F.col("len") == F.col("_size")))
                  .select("item_id", "len", "f", "g1", "g2").distinct())
    prints = windows.select("len", "f").distinct()
    whole = windows.select("len", "f", "g1", "g2").distinct()
    n = windows.count()

    texts = docs.select(*text_key(F.col("text")), "text")
    suspects = cut(_fingerprints(texts, ["k1", "k2"], shorts)
                   .join(broadcast_if_small(prints, n), ["len", "f"], "left_semi")
                   .select("k1", "k2").distinct())
    suspect_texts = (texts.join(broadcast_if_small(suspects, suspects.count()), ["k1", "k2"], "left_semi")
                     .groupBy("k1", "k2").agg(F.first("text").alias("text")))
    found = cut(_windows(suspect_texts, ["k1", "k2"], shorts)
                .join(broadcast_if_small(whole, n), ["len", "f", "g1", "g2"], "left_semi"))

    before = Window.partitionBy("k1", "k2").orderBy("at", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("len")
    new = end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = (found.select("k1", "k2", F.greatest(new, F.lit(0)).alias("_new"))
           .groupBy("k1", "k2").agg(F.sum("_new").cast("long").alias("n_hit")))
    items = (found.select("k1", "k2", "len", "f", "g1", "g2").distinct()
             .join(broadcast_if_small(windows, n), ["len", "f", "g1", "g2"])
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    return hit.join(items, ["k1", "k2"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items and contaminated for every row of ``docs``
    (doc_id, text), against ``benchmark`` (item_id, text).

    Null and empty texts have no words and no hits.  Items without words have
    no window; items without an id mark words but are not listed.  Repeated
    rows each get their result; ties cannot arise; an empty benchmark leaves
    all documents clean, and an empty table gives no rows.  Other columns are
    not read."""
    hits = cut(find_hits(docs, benchmark))
    rows = docs.select("doc_id", *text_key(F.col("text")), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return (rows.join(broadcast_if_small(hits, hits.count()), ["k1", "k2"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with their own columns.  Null and
    empty texts have none and stay, repeated rows stay or go together, an empty
    benchmark keeps all, an empty table gives no rows."""
    hits = cut(find_hits(docs, benchmark).select("k1", "k2"))
    keyed = docs.select(whole_row(docs).alias("_doc"), *text_key(F.col("text")))
    return (keyed.join(broadcast_if_small(hits, hits.count()), ["k1", "k2"], "left_anti").select("_doc.*"))
