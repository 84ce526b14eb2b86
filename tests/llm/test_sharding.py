import itertools
import random
import zlib

import numpy as np

from shelfwise.llm.queries import op9_sharding
from shelfwise.llm.sharding import assign_groups, difference, shard_documents


def _spread(sums, goes, k):
    total = np.zeros(k, np.int64)
    np.add.at(total, goes, sums)
    return int(total.max() - total.min())


def test_differencing_is_a_partition_and_balances():
    rng = np.random.default_rng(2)
    for k, m in ((2, 10), (8, 200), (8, 3)):
        sums = np.zeros((m, k), np.int64)
        sums[:, 0] = rng.integers(1, 10_000, m)
        goes = difference(sums)
        assert all(sorted(row) == list(range(k)) for row in goes.tolist())
        if m == 200:
            assert _spread(sums[:, 0], goes[:, 0], k) < 100
    # the textbook case: 4 5 6 7 8 leaves a difference of 2
    sums = np.array([[x, 0] for x in (8, 7, 6, 5, 4)])
    assert _spread(sums[:, 0], difference(sums)[:, 0], 2) == 2
    assert difference(np.zeros((0, 8), np.int64)).shape == (0, 8)


def test_levels_of_blocks(spark):
    rng = random.Random(3)
    groups = spark.createDataFrame([(i, rng.randrange(1, 5000)) for i in range(900)], "g long, bytes long").repartition(4)
    placed = {r.g: r.shard for r in assign_groups(groups, ["g"], "bytes", 8, block=20, fan_in=5).collect()}
    assert len(placed) == 900
    totals = [0] * 8
    for r in groups.collect():
        totals[placed[r.g]] += r.bytes
    assert max(totals) - min(totals) < 0.01 * sum(totals) / 8   # blocks of 20 groups leave little to balance with


def test_odd_rows(documents, clashes):
    rows = [(1, None), (2, ""), (3, "same"), (4, "same"), (4, "same"), (None, "é"), (5, "b" * 1000)]
    docs = documents(rows, clashes)
    got = shard_documents(docs).collect()
    assert sorted(r.size for r in got) == sorted(len((t or "").encode()) + 1 for _, t in rows)
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"same")}) == 1
    for shard, slots in itertools.groupby(sorted((r.shard, r.slot) for r in got), key=lambda x: x[0]):
        assert [s for _, s in slots] == list(range(sum(r.shard == shard for r in got)))
    assert shard_documents(docs.limit(0)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op9_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    shard_of, totals, slots = {}, [0] * 8, [[] for _ in range(8)]
    for r in got:
        text = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "bytes", None)
        assert shard_of.setdefault(text, r.shard) == r.shard
        totals[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(totals) - min(totals) < 0.02 * sum(totals) / 8


def test_very_long_texts(documents):
    """A text larger than all others together is a shard of its own."""
    rows = [(0, "é" * 400_000)] + [(i, f"text number {i} " * 20) for i in range(1, 60)] + [(0, "é" * 400_000)]
    got = shard_documents(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append((r.doc_id, r.size))
    assert len(got) == len(rows) and [(0, 800_001)] * 2 in by.values()
    rest = [sum(s for _, s in v) for v in by.values() if v != [(0, 800_001)] * 2]
    assert len(rest) == 7 and max(rest) - min(rest) <= 400
