"""Sorts, top-N and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: ranking rows the reports use.
TOP_N = 2000


def by_rank(popular: DataFrame) -> DataFrame:
    """O1: ranking in popularity order."""
    return popular.orderBy("Pop", "GTIN")


def top_n(popular: DataFrame, n: int = TOP_N, fan_in: int | None = None) -> DataFrame:
    """O2: the ``n`` most popular rows (GTIN breaks rank ties).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every partition
    keeps its own top ``n`` and the merge task streams those through a heap
    of ``n`` rows, so memory is bounded by ``n``.  The merge still reads
    ``n`` rows per input partition; a ranking report is small (thousands of
    rows), but for a ranking spread over very many partitions ``fan_in=K``
    adds a level: rows are spread over K groups, each group keeps its top
    ``n`` (a window limit Spark applies before its shuffle), and the final
    merge reads at most K x ``n`` rows.
    """
    order = [F.col("Pop").asc_nulls_last(), F.col("GTIN").asc_nulls_last()]
    if fan_in:
        group = F.xxhash64(*popular.columns) % fan_in
        w = Window.partitionBy("_grp").orderBy(*order)
        popular = (popular.withColumn("_grp", group).withColumn("_rk", F.row_number().over(w))
                   .filter(F.col("_rk") <= n).drop("_grp", "_rk"))
    return popular.orderBy(*order).limit(n)


def output_order(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O3: final report ordering."""
    return df.orderBy(*cols)


def global_row_number(df: DataFrame, order: Sequence[Column], coarse: Column, name: str = "Pop") -> DataFrame:
    """1-based position of every row in ``order`` (which must be a total
    order), without a single-partition window over the rows.

    ``coarse`` is a number that never falls along ``order`` (for a price in
    falling order, minus its whole part).  Rows are numbered within each value
    of it, and the running count of the values before gives the offset; only
    that table, one row per value, is summed in one task.  The plan is lazy,
    depends on the data alone, and keeps nothing on disk."""
    rows = df.withColumn("_coarse", coarse)
    counts = rows.groupBy("_coarse").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy(F.col("_coarse").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_coarse").alias("_at"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_coarse").orderBy(*order)
    return (rows.join(offsets, F.col("_coarse").eqNullSafe(F.col("_at")))
            .withColumn(name, F.col("_off") + F.row_number().over(within))
            .drop("_coarse", "_at", "_off"))


#: Rows of a range that ``equi_depth_rank`` numbers in one task, about, and most ranges.
RANGE_ROWS = 1_000_000
MOST_RANGES = 4096


def _cuts(df: DataFrame, ranges: int) -> list[tuple[float, int | None]]:
    """At most ``2 * ranges`` places (value, tie) that cut the rows into parts
    of about equal size; tie None stands after all rows of the value.  From
    mergeable quantile sketches: one over the values, one over the ties of each
    value that fills more than a part by itself (at most ``ranges`` of them)."""
    shares = [i / ranges for i in range(1, ranges)]
    accuracy = 20 * ranges
    borders = df.agg(F.percentile_approx("_value", shares, accuracy)).first()[0] or []
    parts = {v: borders.count(v) for v in set(borders)}
    common = [v for v, n in parts.items() if n > 1]
    cuts: list[tuple[float, int | None]] = [(v, None) for v in parts]
    if common:
        ties = (df.filter(F.col("_value").isin(common)).groupBy("_value")
                .agg(F.percentile_approx("_tie", shares, accuracy).alias("t")).collect())
        for row in ties:
            n = parts[row["_value"]] + 1
            cuts += [(row["_value"], t) for t in {row["t"][len(shares) * i // (n + 1)] for i in range(1, n + 1)}]
            # the rows before a common value are a part of their own
            cuts.append((row["_value"], _BEFORE_ALL))
    return sorted(set(cuts), key=lambda c: (c[0], float("inf") if c[1] is None else c[1]))


_BEFORE_ALL, _AFTER_ALL = -(1 << 63), (1 << 63) - 1


def _range_of(cuts: list[tuple[float, int | None]]) -> Column:
    """A number that rises with the sorted ``cuts`` before a row: first among
    every sixty-fourth, then among those that follow."""
    row = F.struct(F.col("_value").alias("v"), F.col("_tie").alias("t"))
    item = lambda c: F.struct(F.lit(float(c[0])).alias("v"),
                              F.lit(_AFTER_ALL if c[1] is None else c[1]).cast("bigint").alias("t"))
    if not cuts:
        return F.lit(0)
    steps = [cuts[i:i + 64] for i in range(0, len(cuts), 64)]
    passed = lambda items: F.size(F.filter(items, lambda c: c < row))
    whole = passed(F.array(*[item(s[-1]) for s in steps]))
    inside = passed(F.coalesce(F.get(F.array(*[F.array(*map(item, s)) for s in steps]), whole),
                               F.array().cast("array<struct<v:double,t:bigint>>")))
    return whole * 64 + inside


def equi_depth_rank(df: DataFrame, value: Column, tie: Column, name: str = "Pop", ranges: int | None = None) -> DataFrame:
    """O1 over a ranking of any size: the 1-based position of every row by
    ``value`` (a number, ascending, nulls last), then by ``tie`` (an integer,
    ascending, not null), which together are unique.

    Rows are dealt into ranges of about equal size, also where one value is
    very common, numbered within their range, and moved on by the sizes of the
    ranges before.  Only that table, one row a range, is summed in one task.
    The ranges come from quantile sketches; any borders give the same
    positions, so recomputed tasks agree.  ``ranges`` is by default one for every
    ``RANGE_ROWS`` rows, at most ``MOST_RANGES``."""
    rows = df.withColumns({"_value": value.cast("double"), "_tie": tie.cast("bigint")})
    if ranges is None:
        ranges = max(1, min(MOST_RANGES, -(-rows.count() // RANGE_ROWS)))
    cuts = _cuts(rows.select("_value", "_tie"), ranges) if ranges > 1 else []
    last = 64 * (len(cuts) // 64 + 2)                 # beyond every number of ``_range_of``
    rows = rows.withColumn("_range", F.when(F.col("_value").isNull(), last).otherwise(_range_of(cuts)))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_range").orderBy("_value", "_tie")
    return (rows.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_off") + F.row_number().over(within)).drop("_value", "_tie", "_range", "_off"))


def union_pulls(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Concatenate daily pulls held as separate frames (UNION ALL by
    column name).  Pulls that lie in one table or folder are one read instead
    (``functions.dates.report_days``).  A column that a pull lacks is an error
    unless ``allow_missing`` fills it with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
