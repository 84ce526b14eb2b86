"""Joins (J1-J11).  All equi-joins; keys are computed into columns first so
Spark hash-partitions (or broadcasts) on plain column equality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import gtin_key


def feed_ads_join(feed: DataFrame, ads_totals: DataFrame) -> DataFrame:
    """Feed variants x ad totals on GID (fans metrics out to variants)."""
    return feed.join(ads_totals, "GID")


def heavy_keys(df: DataFrame, key: str, share: float) -> dict:
    """The values of ``key`` that may hold at least ``share`` of the rows, with
    their rows by estimate; null is none.  One pass with a mergeable summary of
    frequent items, of a size that depends on ``share`` alone; no value above
    ``share`` is missed."""
    most = 1 << max(4, int(8 / share).bit_length())
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {int(2 / share)}, {most})").alias("top")).first()
    return {r["item"]: r["count"] for r in found["top"] or [] if r["count"] >= share * found["n"]}


def salted_join(left: DataFrame, right: DataFrame, key: str, share: float = 1 / 16) -> DataFrame:
    """Inner join on ``key`` where a few values hold much of ``left``.

    Only these values are salted: their rows of ``left`` are dealt out by a
    hash of the row to about an eighth of ``share`` of the rows each, so that
    several of these in one task are no burden, and their rows of
    ``right`` are repeated for every salt.  All other rows keep salt 0.  The
    same rows as a plain join; equal rows of ``left`` stay together."""
    heavy = heavy_keys(left, key, share)
    if not heavy:
        return left.join(right, key)
    total = left.count()
    salts = {v: max(2, -(-8 * n // max(1, int(share * total)))) for v, n in heavy.items()}
    of = F.lit(1)
    for value, n in salts.items():                    # at most 2 / share values
        of = F.when(F.col(key) == F.lit(value), n).otherwise(of)
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), of).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), of - 1)))
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")


def gtin_prefix_join(left: DataFrame, ranking: DataFrame, feed_drop: int = 2, rank_drop: int = 4,
                     clean: bool = False, heavy_share: float | None = None) -> DataFrame:
    """Partial GTIN match.  The feed GTIN loses ``feed_drop`` trailing
    characters, the ranking GTIN ``rank_drop``; rows with equal prefixes
    join.  The ranking side is a top-N cut; adaptive execution broadcasts it
    when its measured size allows.  Beyond that, ``heavy_share`` spreads the
    rows of a key that holds so much of the feed (the empty key of short codes,
    or ``nan``) over several tasks."""
    l = left.withColumn("_gtin_key", gtin_key("GTIN", feed_drop, clean))
    r = ranking.withColumn("_gtin_key", gtin_key("GTIN", rank_drop if not clean else feed_drop, clean))
    r = r.drop("GTIN")
    if clean:
        l = l.filter(F.col("_gtin_key").isNotNull())
    joined = l.join(r, "_gtin_key") if heavy_share is None else salted_join(l, r, "_gtin_key", heavy_share)
    return joined.drop("_gtin_key")


def gtin_pairs(feed: DataFrame, ranking: DataFrame, feed_drop: int = 2, rank_drop: int = 4, clean: bool = False) -> DataFrame:
    """J2 + A3 when only the matched (Pop, GID) pairs are needed.

    The feed side is reduced to distinct (GID, key) before the join, so the
    join emits no more rows than there are matched pairs: variants sharing
    a prefix collapse first.  Short codes give the empty key, which matches
    every ranking row with an empty key (the literal rule; ``clean=True``
    drops empty keys), so without this step one common short code would
    multiply the feed by the ranking size."""
    keys = feed.select("GID", gtin_key("GTIN", feed_drop, clean).alias("_gtin_key")).distinct()
    if clean:
        keys = keys.filter(F.col("_gtin_key").isNotNull())
    r = ranking.select("Pop", gtin_key("GTIN", rank_drop if not clean else feed_drop, clean).alias("_gtin_key"))
    return keys.join(r, "_gtin_key").select("Pop", "GID").distinct()


def match_rows(linking: DataFrame, pairs: DataFrame) -> DataFrame:
    """Linking rows x matched (Pop, GID) pairs on GID."""
    return linking.join(pairs, "GID")


def lower_key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   also: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """LOWER(left_key) = LOWER(right_key) plus equal ``also`` columns."""
    l = left.withColumn("_k", F.lower(F.col(left_key)))
    r = right.withColumn("_k", F.lower(F.col(right_key)))
    return l.join(r, ["_k", *also], how).drop("_k")


def keep_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key appears in ``keys`` (LEFT SEMI)."""
    return df.join(keys, on, "left_semi")
