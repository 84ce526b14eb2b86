"""Sum-of-squares packing of documents into token windows.

Each task packs the documents that it reads, online: a piece goes to the fill
level that gives the smallest sum of squared counts of partially filled
windows.  The counts live in one array indexed by fill level.  No row is
shuffled, and a task holds only its open windows.

At the end of a task (and whenever ``max_open`` windows are open) the open
windows are cut anew into full ones; what is left at the end of a task becomes
windows of power-of-two lengths, which need no padding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers
from .encoding import VOCABULARY, encoder

WINDOW = 2048
END_ID = 1
MAX_OPEN = 2048
#: A task's sequence numbers follow its partition number times this.
PER_TASK = 1 << 40

_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                  ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                  ("offset", pa.int64()), ("sequence_length", pa.int64())])
_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
           "sequence_id long, offset long, sequence_length long")


class Packer:
    """Open windows by fill level, for one task."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN, first_id: int = 0):
        self.window, self.max_open, self.next_id = window, max_open, first_id
        self.count = np.zeros(window + 1, np.int64)   # open windows at each fill level
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.n_open = 0
        self.done: list[tuple] = []                   # rows of closed windows

    def add(self, doc_id, ids: np.ndarray) -> None:
        """Cut a document at the window length and place its pieces."""
        n = len(ids)
        whole = n - n % self.window
        for at in range(0, whole, self.window):
            self._close([(doc_id, at, ids[at:at + self.window], n)])
        if whole < n:
            self._place((doc_id, whole, ids[whole:], n))

    def level_for(self, size: int) -> int:
        """Fill level (0: a new window) that a piece of ``size`` tokens joins.
        Moving a window from level h to h + size changes the sum of squares by
        2 * (count[h + size] - count[h]) + 2, without the part of the target
        when that is full.  Ties go to the fullest window."""
        top = self.window - size
        rise = self.count[size:size + top + 1] * 2 + 1
        rise[top] = 0                                 # a full window is no longer counted
        rise[1:] -= self.count[1:top + 1] * 2 - 1
        rise[1:][self.count[1:top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(rise[::-1]))

    def _place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        else:
            held = []
        held.append(piece)
        if level + size == self.window:
            self._close(held)
            return
        self.open[level + size].append(held)
        self.count[level + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.flush(final=False)

    def _close(self, pieces: list[tuple]) -> None:
        offset, length = 0, sum(len(p[2]) for p in pieces)
        for doc_id, start, ids, n in pieces:
            self.done.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), n,
                              self.next_id, offset, length))
            offset += len(ids)
        self.next_id += 1

    def flush(self, final: bool = True) -> None:
        """Cut the open windows' pieces into full windows; at the end, the
        rest into windows of power-of-two lengths."""
        pieces = [p for level in reversed(self.open) for held in level for p in held]
        self.open = [[] for _ in range(self.window + 1)]
        self.count[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) for p in pieces)
        held, room = [], self._next_length(left)
        for doc_id, start, ids, n in pieces:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                held.append((doc_id, start, part, n))
                start, room, left = start + len(part), room - len(part), left - len(part)
                if not room:
                    self._close(held)
                    held, room = [], self._next_length(left)
                    if not final and left < self.window:
                        room = self.window
        for piece in held:                            # only while the task goes on
            self._place(piece)

    def _next_length(self, left: int) -> int:
        return self.window if left >= self.window else 1 << max(left.bit_length() - 1, 0)

    def take(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        columns = list(zip(*rows)) if rows else [()] * len(_OUT)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID,
         vocabulary: str = VOCABULARY, max_open: int = MAX_OPEN) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``window`` tokens.

    One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens (with the end id), sequence_id, offset, sequence_length.

    A null or empty text is its end id alone.  Texts longer than a window are
    cut at its length.  Repeated rows are packed as often as they stand, a null
    doc_id stays null, and an empty table gives no rows.  Other columns are not
    read.  ``sequence_length`` is ``window`` or a power of two."""
    python_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        packer = Packer(window, max_open, TaskContext.get().partitionId() * PER_TASK)
        end = np.asarray([end_id], "<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(doc_id, np.concatenate((encode(text), end)))
            yield packer.take()
        packer.flush()
        yield packer.take()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
            .mapInArrow(run, _SCHEMA))
