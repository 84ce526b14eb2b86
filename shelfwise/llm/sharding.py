"""Balanced shards of whole groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that no shard boundary may split.
Differencing keeps partial partitions (as many subsets as shards) and again and
again combines the two with the largest spread, oppositely ordered, so that the
heavy subsets of one join the light subsets of the other.  It is associative:
tasks difference blocks of groups, and the blocks' partial partitions, a few
numbers each, are differenced in turn, level by level."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, python_workers, text_key

SHARDS = 8
#: Groups that one call differences; a task cuts its groups into such blocks.
BLOCK = 50_000
#: Partial partitions that one task of the upper levels differences.
FAN_IN = 4096
#: Ranges of a shard that are numbered apart from each other.
RANGES = 512


def difference(sums: np.ndarray) -> np.ndarray:
    """Combine partial partitions (rows of ``sums``, one column per subset) and
    return, for each row and subset, the subset of the result it goes to."""
    m, k = sums.shape
    if m == 0:
        return np.empty((0, k), np.int64)
    parts = [sorted(((int(v), j) for j, v in enumerate(row)), reverse=True) for row in sums.tolist()]
    heap = [(p[-1][0] - p[0][0], i) for i, p in enumerate(parts)]  # minus the spread, then age
    heapq.heapify(heap)
    made: list[tuple] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        light = parts[b][::-1]
        new = sorted(((x[0] + y[0], j) for j, (x, y) in enumerate(zip(parts[a], light))), reverse=True)
        made.append((a, [x[1] for x in parts[a]], b, [y[1] for y in light]))
        parts[a] = parts[b] = None
        parts.append(new)
        heapq.heappush(heap, (new[-1][0] - new[0][0], len(parts) - 1))
    goes: list = [None] * len(parts)
    final = [0] * k
    for place, (_, j) in enumerate(parts[-1]):
        final[j] = place
    goes[-1] = final
    for i in range(len(made) - 1, -1, -1):
        to, (a, in_a, b, in_b) = goes[m + i], made[i]
        goes[m + i] = None
        for part, inside in ((a, in_a), (b, in_b)):
            own = [0] * k
            for j, subset in enumerate(inside):
                own[subset] = to[j]
            goes[part] = own
    return np.asarray(goes[:m], np.int64)


def assign_groups(groups: DataFrame, keys: list[str], size: str, shards: int = SHARDS,
                  block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """``keys`` and ``shard`` of every row of ``groups``; ``size`` (long) is
    balanced.  Reads each group once; the upper levels see ``shards`` numbers
    per block."""
    python_workers(groups.sparkSession)
    kinds = dict(groups.dtypes)
    key_schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, made = [], 0, 0

        def out(frame: pd.DataFrame) -> pd.DataFrame:
            sums = np.zeros((len(frame), shards), np.int64)
            sums[:, 0] = frame["_size"].to_numpy()
            frame["_block"] = (TaskContext.get().partitionId() << 32) + made
            frame["_bin"] = difference(sums)[:, 0]
            return frame

        for batch in batches:
            while len(batch):
                part, batch = batch.iloc[:block - n], batch.iloc[block - n:]
                held.append(part)
                n += len(part)
                if n == block:
                    yield out(pd.concat(held, ignore_index=True))
                    held, n, made = [], 0, made + 1
        if n:
            yield out(pd.concat(held, ignore_index=True))

    placed = cut(groups.select(*keys, F.col(size).cast("long").alias("_size"))
                 .mapInPandas(leaves, f"{key_schema}, _size long, _block long, _bin long"))

    def join_parts(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_part", "_own"], ignore_index=True)
        _, row = np.unique(frame["_part"].to_numpy(), return_inverse=True)
        sums = np.zeros((row.max() + 1, shards), np.int64)
        np.add.at(sums, (row, frame["_own"].to_numpy()), frame["_size"].to_numpy())
        frame["_up"] = difference(sums)[row, frame["_own"].to_numpy()]
        return frame[["_node", "_part", "_own", "_up"]]

    leaf = cut(placed.groupBy(F.col("_block"), F.col("_bin")).agg(F.sum("_size").alias("_size")))
    order = Window.orderBy("_block")
    ids = cut(leaf.select("_block").distinct().select("_block", (F.row_number().over(order) - 1).cast("long").alias("_part")))
    n = ids.count()
    way = leaf.join(ids, "_block").select("_block", "_bin", "_part", F.col("_bin").alias("_own"), "_size")
    while n > 0:
        n = -(-n // fan_in)
        parts = (way.groupBy("_part", "_own").agg(F.sum("_size").alias("_size"))
                 .withColumn("_node", F.floor(F.col("_part") / fan_in).cast("long")))
        up = parts.groupBy("_node").applyInPandas(join_parts, "_node long, _part long, _own long, _up long")
        way = cut(way.join(up, ["_part", "_own"])
                  .select("_block", "_bin", F.col("_node").alias("_part"), F.col("_up").alias("_own"), "_size"))
        if n == 1:
            break
    return (placed.join(way.select("_block", "_bin", F.col("_own").cast("int").alias("shard")), ["_block", "_bin"])
            .select(*keys, "shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, text key (k1, k2), size, text_crc32, shard, slot and the size of
    its group (group_rows) for every row of ``docs`` (doc_id, text).

    Size is the text's UTF-8 bytes plus one.  Rows with equal texts share a
    shard; null counts as the empty text.  ``slot`` numbers a shard's rows from
    0 without gaps, in the order of ranges of hashed ids; ties (repeated ids)
    are numbered in any order.  A group larger than a shard's fair share makes
    that shard larger, as groups are never split.  An empty table gives no
    rows, and other columns are not read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), *text_key(text))
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("group_size"),
                                          F.count(F.lit(1)).alias("group_rows"))
    shard_of = assign_groups(groups, ["k1", "k2"], "group_size", shards)
    placed = cut(rows.join(shard_of, ["k1", "k2"])
                 .withColumn("_range", F.pmod(F.xxhash64("doc_id", "k2"), F.lit(RANGES)).cast("int")))
    before = (Window.partitionBy("shard").orderBy("_range")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (placed.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
              .select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = Window.partitionBy("shard", "_range").orderBy("doc_id", "k1", "k2")
    return (placed.withColumn("_at", F.row_number().over(within) - 1)
            .join(starts, ["shard", "_range"])
            .select("doc_id", "k1", "k2", "size", "text_crc32", "shard",
                    (F.col("_start") + F.col("_at")).alias("slot")))
