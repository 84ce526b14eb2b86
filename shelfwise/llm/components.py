"""Connected components of a link table by alternating stars.

Each round points every node's larger neighbours (large star), then its smaller
neighbours (small star), at the smallest node it sees.  Rounds repeat until the
links no longer change; the number of rounds grows with the logarithm of the
component size.  The smallest neighbours are written to the checkpoint folder
before they are joined back, as a table of one row per node: a node with very
many links is combined before it moves, and its links need not meet in one
task.  Each round is written there as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stored


#: Links that one task takes: a table of two longs of less than a megabyte.
FEW_LINKS = 50_000


def _with_least(links: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    """``links`` with the value ``m`` that ``least`` has for u."""
    if few:
        return links.join(least, "u")
    least = stored(least, "least")
    return links.join(broadcast_if_small(least, least.count()), "u")


def _print_of(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every
    node but the roots themselves.  ``links`` has two long columns u and v;
    loops and repeated links are allowed.

    Rounds over at most ``FEW_LINKS`` links run in one task each, so a small
    table does not pass through many empty ones; larger tables are shuffled."""
    now = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .filter(F.col("u") != F.col("v")).distinct(), "links")
    before = None
    while (state := _print_of(now)) != before:
        before = state
        if not state[0]:
            break
        few = state[0] <= FEW_LINKS
        now = now.coalesce(1) if few else now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(1) if few else both
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (_with_least(both, least, few).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct())
        large = stored(large, "large")
        large = large.coalesce(1) if few else large
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least, few).select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("_l")).select("_l.*")
        now = stored(small.filter(F.col("u") != F.col("v")).distinct(), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
