"""The four-week decline rule, as one window pass instead of a per-product loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The decline rule.
DECLINE_PERCENT = 0.5
WEEKS = 4

TIE_BREAK = ("productName", "Clicks", "yearNum", "Impressions", "Cost", "ConversionValue",
             "itemRev", "buyToDetailRate", "country")


def decline_rule(rows: DataFrame, key: str = "ID", value: str = "newROAS",
                 percent: float = DECLINE_PERCENT, weeks: int = WEEKS,
                 order_by_year: bool = False, tie_break: Sequence[str] = TIE_BREAK) -> DataFrame:
    """Keep the rows of every key that has exactly ``weeks`` rows and whose
    last-week value is below ``percent`` x the first-week value.

    Rows are ordered by weekNum (optionally year first); the remaining
    columns break ties so the choice is deterministic.  The per-key count,
    first and last value are window aggregates over the key's rows in one
    pass (``min_by`` / ``max_by`` over the whole partition).  The rows here
    are weekly aggregates -- per key at most weeks x accounts x product
    names -- so a partition never holds raw rows, and the matched rows are
    computed once (a separate aggregate joined back would recompute the
    whole upstream plan in a second, differently pruned branch).
    """
    order_cols = (["yearNum", "weekNum"] if order_by_year else ["weekNum"])
    order_cols += [c for c in tie_break if c not in order_cols]
    order = F.struct(*[F.col(c) for c in order_cols])
    per_key = Window.partitionBy(key)
    marked = rows.select(
        "*",
        F.count(F.lit(1)).over(per_key).alias("_n"),
        F.min_by(value, order).over(per_key).alias("_first"),
        F.max_by(value, order).over(per_key).alias("_last"),
    )
    not_declining = F.col("_last").cast("double") >= F.col("_first").cast("double") * percent
    kept = marked.filter((F.col("_n") == weeks) & ~F.coalesce(not_declining, F.lit(False)))
    return kept.drop("_n", "_first", "_last")
