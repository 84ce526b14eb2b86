"""Runs of repeated words, found with longest common extensions.

A run is a stretch of words with a smallest period q and a length of at least
``max(LEAST_WORDS, EXPONENT * q)`` that cannot be extended with that period.
For every period p the pairs of words (x, x + p) are looked at on a grid so
wide that each run of period p holds at least one grid pair: about n / (3 p)
pairs, a harmonic sum over all periods.  The longest common extensions of a
pair, forwards and backwards, give the whole run.

Extensions come from a difference cover: only suffixes that start at cover
positions (6 of every 31) are sorted, by blocks of 31 words and then by
doubling along each residue.  A query compares words until both sides stand on
cover positions at once, fewer than 31 words on, and asks a sparse table of
range minima over the sorted suffixes' common prefixes for the rest.  Texts
whose pairs all end within those few words need no sorting.

A batch of texts is one array of word numbers, each text closed by a number of
its own, so numpy answers all texts' queries together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_workers

LEAST_WORDS = 6
EXPONENT = 4
#: A difference cover: every difference modulo 31 is one of two of its members.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Grid pairs looked at together.
CHUNK = 1 << 20

_RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
_ARROW_RUN = ("start", "length", "period")


def _sync() -> np.ndarray:
    """By the residues of two positions: the least step after which both are
    cover positions."""
    in_cover = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    a, b = np.indices((MODULUS, MODULUS))
    out = np.full((MODULUS, MODULUS), -1, np.int64)
    for step in range(MODULUS - 1, -1, -1):
        out[in_cover[a + step] & in_cover[b + step]] = step
    return out


_SYNC = _sync()


def _agree(ids: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words from ``i`` and ``j`` on are equal, at most ``limit``."""
    count = np.zeros(len(i), np.int64)
    live = np.flatnonzero(limit > 0)
    step = 0
    while len(live):
        live = live[ids[i[live] + step] == ids[j[live] + step]]
        step += 1
        count[live] = step
        live = live[limit[live] > step]
    return count


class Extensions:
    """Longest common extensions to the right in ``ids``, whose texts are each
    closed by a number that occurs once."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.concatenate((ids, np.full(MODULUS, -1, ids.dtype)))
        chains = [np.arange(r, len(ids), MODULUS) for r in COVER]
        self.spots = np.concatenate(chains)
        self.base = np.zeros(MODULUS, np.int64)       # where a residue's chain begins
        sizes = np.array([len(c) for c in chains])
        self.base[list(COVER)] = np.cumsum(sizes) - sizes
        ends = np.repeat(np.cumsum(sizes), sizes)
        levels = self._order(ends)
        self.rank = levels[-1]
        self.table = self._minima(self._common(levels, ends))

    def _order(self, ends: np.ndarray) -> list[np.ndarray]:
        """Ranks of the cover suffixes by their first 31, 62, 124, ... words."""
        blocks = np.lib.stride_tricks.sliding_window_view(self.ids, MODULUS)[self.spots]
        blocks = np.ascontiguousarray(blocks).view(np.dtype((np.void, MODULUS * blocks.itemsize))).ravel()
        ranks = [np.unique(blocks, return_inverse=True)[1].astype(np.int64)]
        step, places = 1, np.arange(len(self.spots))
        while len(places) and int(ranks[-1].max()) + 1 < len(places):
            now = ranks[-1]
            after = np.where(places + step < ends, now[np.minimum(places + step, len(places) - 1)], -1)
            ranks.append(np.unique(now * (len(places) + 1) + after + 1, return_inverse=True)[1].astype(np.int64))
            step *= 2
        return ranks

    def _common(self, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        """Common prefix of each cover suffix, in their order, with the one
        before it."""
        order = np.argsort(levels[-1], kind="stable")
        a, b = order[:-1].copy(), order[1:].copy()
        done = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 2, -1, -1):
            ranks = levels[level]
            last = len(ranks) - 1
            fits = (a < ends[order[:-1]]) & (b < ends[order[1:]])
            same = fits & (ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)])
            a[same] += 1 << level
            b[same] += 1 << level
            done[same] += MODULUS << level
        at_a, at_b = self.spots[order[:-1]] + done, self.spots[order[1:]] + done
        return np.concatenate(([0], done + _agree(self.ids, at_a, at_b, np.full(len(done), MODULUS))))

    @staticmethod
    def _minima(common: np.ndarray) -> list[np.ndarray]:
        table, width = [common], 1
        while 2 * width <= len(common):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        step = _SYNC[i % MODULUS, j % MODULUS]
        out = _agree(self.ids, i, j, step)
        far = np.flatnonzero(out == step)
        if len(far):
            i, j = i[far] + step[far], j[far] + step[far]
            u = self.rank[self.base[i % MODULUS] + i // MODULUS]
            v = self.rank[self.base[j % MODULUS] + j // MODULUS]
            low, high = np.minimum(u, v) + 1, np.maximum(u, v) + 1
            level = np.floor(np.log2(high - low)).astype(np.int64)
            rest = np.empty(len(far), np.int64)
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                row = self.table[k]
                rest[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
            out[far] += rest
        return out


def _span(period: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Equal pairs that a run of each period has at least: its grid's step."""
    return np.maximum(least, exponent * period) - period


def _grid(starts: np.ndarray, lengths: np.ndarray, least: int, exponent: int) -> Iterator[tuple]:
    """Chunks of grid pairs of the texts at ``starts``: text, x and period."""
    top = np.where(lengths >= least, lengths // exponent, 0)
    for first, last in _cuts(top, CHUNK):
        text = np.repeat(np.arange(first, last), top[first:last])
        period = np.arange(len(text)) - np.repeat(np.cumsum(top[first:last]) - top[first:last], top[first:last]) + 1
        step = _span(period, least, exponent)
        pairs = (lengths[text] - 1 - period) // step + 1
        for a, b in _cuts(pairs, CHUNK):
            n = pairs[a:b]
            number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            which = np.repeat(np.arange(a, b), n)
            yield text[which], starts[text[which]] + number * step[which], period[which]


def _cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes sum to about ``most``."""
    group = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(group)) + 1
    bounds = [0, *edges.tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if b > a)


def _smallest(rows: list[np.ndarray]) -> np.ndarray:
    """Rows (text, start, end, period), of each stretch that with the smallest
    period: the others are its multiples."""
    if not rows:
        return np.empty((0, 4), np.int64)
    rows = np.concatenate(rows)
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[first]


def find_runs(texts: list[np.ndarray], least: int = LEAST_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """All runs of the texts (arrays of word numbers from 0) as rows (text,
    start, length, period), by text, start and period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    found, long = _near_runs(*_joined(texts, lengths), lengths, least, exponent)
    rest = np.flatnonzero(long)
    if len(rest):
        far = _far_runs(*_joined([texts[i] for i in rest], lengths[rest]), lengths[rest], least, exponent)
        far[:, 0] = rest[far[:, 0]]
        found = np.concatenate((found, far))
    found = found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]
    return np.column_stack((found[:, 0], found[:, 1], found[:, 2] - found[:, 1], found[:, 3]))


def _joined(texts: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, with a number of its own before the first and
    after each, and where each begins."""
    starts = np.cumsum(lengths + 1) - lengths
    most = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    ids = np.empty(int(lengths.sum()) + len(texts) + 1, np.int32)
    ids[0] = most
    ids[starts + lengths] = most + 1 + np.arange(len(texts))
    for start, text in zip(starts.tolist(), texts):
        ids[start:start + len(text)] = text
    return ids, starts


def _near_runs(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int, exponent: int) -> tuple:
    """Runs of the texts whose pairs all differ within a few words, and which
    texts have other pairs."""
    padded = np.concatenate((ids, np.full(MODULUS, -1, np.int32)))
    back = np.concatenate((ids[::-1], np.full(MODULUS, -1, np.int32)))
    long, rows = np.zeros(len(starts), bool), []
    for text, x, period in _grid(starts, lengths, least, exponent):
        y = x + period
        equal = np.flatnonzero(padded[x] == padded[y])
        text, x, y, period = text[equal], x[equal], y[equal], period[equal]
        few = np.full(len(x), MODULUS)
        after = _agree(padded, x, y, few)
        before = _agree(back, len(ids) - x, len(ids) - y, few)      # from just before the pair
        long[text[(after == MODULUS) | (before == MODULUS)]] = True
        whole = np.flatnonzero(after + before >= _span(period, least, exponent))
        rows.append(_smallest([_rows(text, x, y, before, after, period, starts, whole)]))
    rows = _smallest(rows)
    return rows[~long[rows[:, 0]]], long


def _rows(text, x, y, before, after, period, starts, whole) -> np.ndarray:
    base = starts[text[whole]]
    return np.column_stack((text[whole], x[whole] - before[whole] - base, y[whole] + after[whole] - base, period[whole]))


def _far_runs(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """All runs of the texts, by the difference cover."""
    forward, backward = Extensions(ids), Extensions(np.ascontiguousarray(ids[::-1]))
    rows = []
    for text, x, period in _grid(starts, lengths, least, exponent):
        y = x + period
        equal = np.flatnonzero(ids[x] == ids[y])
        text, x, y, period = text[equal], x[equal], y[equal], period[equal]
        after, before = forward(x, y), backward(len(ids) - x, len(ids) - y)
        whole = np.flatnonzero(after + before >= _span(period, least, exponent))
        rows.append(_smallest([_rows(text, x, y, before, after, period, starts, whole)]))
    return _smallest(rows)


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length and period in words, by start
    and period) and ``collapsed`` (the words joined by a space, of each run only
    its first period) for every row of ``docs`` (doc_id, text).

    Words are separated by spaces and the characters 9 to 13.  A null text has
    no words, no runs and an empty ``collapsed``, like an empty one.  Whole texts
    are read; a task holds one batch of them at a time.  Repeated rows are
    reported as often as they stand, a null doc_id stays null, an empty table
    gives no rows, other columns are not read."""
    python_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _one_batch(batch, least, exponent)

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", _RUNS), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _one_batch(batch: pa.RecordBatch, least: int, exponent: int) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    words = [text.split() if text else [] for text in batch.column(1).to_pylist()]
    texts = [np.array([number.setdefault(w, len(number)) for w in found], np.int32) for found in words]
    runs = find_runs(texts, least, exponent)
    bounds = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
    collapsed = []
    for i, found in enumerate(words):
        if bounds[i] < bounds[i + 1]:
            change = np.zeros(len(found) + 1, np.int64)
            _, start, length, period = runs[bounds[i]:bounds[i + 1]].T
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            found = [found[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(found))
    items = pa.StructArray.from_arrays([pa.array(runs[:, k], pa.int64()) for k in (1, 2, 3)], names=list(_ARROW_RUN))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
         pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items),
         pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])
