"""Spelling variants: words one edit apart, found along a relational trie.

The distinct words are stored as a path-compressed trie in a table of edges
(node, label, child).  A frontier of states (word, rest of its letters, node,
edits) is joined with that table level by level; a state that has used its one
edit and ends at a word's node is a pair of neighbours.

Where two words are one edit apart, the edit lies where they first differ, and
before or after that point at least half of the letters agree.  So the trie
holds every word forwards and backwards, a state enters it at the word's own
nodes beyond its middle, and only words with an equal half ever meet there.  Each
pair is found from one side: a replacement by the word with the smaller letter, a
deletion by the longer word, which is an insertion for the other.

Nodes are 128-bit keys of a prefix and its direction, summed over its letters,
so a word of n letters costs n steps.  A table goes to all tasks only while its
summed size is small; otherwise nodes above very many words are joined apart.
Rounds are as many as the nodes below a word's middle, not as its letters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, python_workers, stored

MIN_CHARS = 5
MIN_COUNT = 3
#: A word's form occurs at least so many times as often.
RATIO = 2

#: Bytes of a table that may go to all tasks (at every level anew), and words below a node that make
#: it one of the few (at most one in so many rows) that are joined apart.
SMALL_BYTES = 4 << 20
HOT_WORDS = 1_000_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 300_000

_RUN = re.compile("[a-zÀ-ÿ]+")
_KEY = ["k1", "k2"]


# ------------------------------------------------------------------ counts

def word_counts(docs: DataFrame, change: Callable | None = None, min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of the distinct words of all texts of ``docs`` (doc_id,
    text): maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased,
    of at least ``min_chars`` code points that occur at least ``min_count``
    times.  ``change(doc_id)``, if given, returns a function that replaces a
    document's words before they are counted.

    A null or empty text has no words, an empty table gives no rows, repeated
    rows count as often as they stand, other columns are not read."""
    python_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                found = _RUN.findall(text.lower().decode())   # bytes: only A-Z have other cases
                if change is None:
                    held.update(found)
                else:
                    replaced = change(doc_id)
                    for word, n in Counter(found).items():
                        held[replaced(word)] += n
                if len(held) > HELD_WORDS:
                    yield counted(held)
                    held.clear()
        yield counted(held)

    def counted(held: Counter) -> pa.RecordBatch:
        items = [(w, n) for w, n in held.items() if len(w) >= min_chars]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in items], pa.string()),
                                           pa.array([n for _, n in items], pa.int64())], names=["word", "n"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# -------------------------------------------------------------------- trie

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix_keys(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, side: int, seed: int) -> np.ndarray:
    """For the letters of all words in a row: the key of each word's prefix
    that ends before that letter, and after the last one (lengths + 1 each)."""
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    values = _mix(codes.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21)) + np.uint64(seed))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    at = np.arange(len(codes) + len(lengths)) - np.repeat(np.arange(len(lengths)), lengths + 1)
    sums = total[at] - np.repeat(total[starts], lengths + 1)
    return _mix(sums + np.uint64(seed + 1 + side)).view(np.int64)


def _prefixes(words: DataFrame, whole: bool = False) -> DataFrame:
    """Every word's prefixes from its middle on, forwards (side 0) and
    backwards (side 1): the word's own key (w1, w2), size and n, the side, the
    depth, the node's key and the code point of the following letter (-1 after
    the last one).  ``whole``: only the words themselves, as ``word``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            lengths = np.array([len(t) for t in texts], np.int64)
            starts, ends = np.cumsum(lengths) - lengths, np.cumsum(lengths + 1)
            of = np.repeat(np.arange(len(texts)), lengths + 1)
            depth = np.arange(len(of)) - np.repeat(ends - lengths - 1, lengths + 1)
            keep = np.flatnonzero(depth == lengths[of] if whole else depth >= (lengths[of] - 1) // 2)
            of, depth = of[keep], depth[keep]
            place, inside = starts[of] + depth, depth < lengths[of]
            n = batch.column(1).take(pa.array(of))
            for side in (0, 1):
                codes = np.frombuffer("".join(t[::-1] if side else t for t in texts).encode("utf-32-le"), np.uint32)
                keys = [_prefix_keys(codes, starts, lengths, side, seed) for seed in (11, 1 << 40)]
                if not side:
                    own = [pa.array(k[ends - 1][of]) for k in keys]
                after = np.where(inside, np.append(codes, 0)[place].astype(np.int32), -1).astype(np.int32)
                columns = [*own, pa.array(lengths[of].astype(np.int32)), n, pa.array(np.full(len(of), side, np.int32)),
                           pa.array(depth.astype(np.int32)), *[pa.array(k[keep]) for k in keys],
                           batch.column(0).take(pa.array(of)) if whole else pa.array(after)]
                yield pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "size", "n", "side", "depth", "k1", "k2",
                                                                 "word" if whole else "after"])

    return words.select("word", "n").mapInArrow(
        run, "w1 long, w2 long, size int, n long, side int, depth int, k1 long, k2 long, "
             + ("word string" if whole else "after int"))


class _Table:
    """A table of the trie with the number of words ``below`` each node, and
    how it is joined: a small one goes to all tasks.  Otherwise only its nodes
    above ``hot_words`` words do, at most one for so many prefixes, and the
    other rows are shuffled, so that no node's states meet in one task."""

    def __init__(self, df: DataFrame, small_bytes: int, hot_words: int):
        texts = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
        total = df.agg(F.sum(sum(texts, F.lit(64)).cast("long")).alias("bytes"), F.max("below").alias("below")).first()
        self.df, self.hot_words = df, hot_words
        self.small = (total.bytes or 0) <= small_bytes
        self.even = (total.below or 0) < hot_words

    def meet(self, left: DataFrame, on: list[str], keep_below: bool = False) -> DataFrame:
        table = self.df if keep_below else self.df.drop("below")
        if self.small:
            return left.join(F.broadcast(table), on)
        if self.even:
            return left.join(table, on)
        hot = F.col("below") >= self.hot_words
        parts = [self.df.filter(hot), self.df.filter(~hot)]
        parts = parts if keep_below else [p.drop("below") for p in parts]
        others = left.join(F.broadcast(parts[0].select(*on).distinct()), on, "left_anti")
        return left.join(F.broadcast(parts[0]), on).unionByName(others.join(parts[1], on))


def _letters(rest: Column, start: int) -> Column:
    """The text from its 1-based place ``start`` on."""
    return F.substring(rest, start, 2_147_483_647)


def _turned(side: Column, word: Column) -> Column:
    return F.when(side == 1, F.reverse(word)).otherwise(word)


def neighbours(words: DataFrame, small_bytes: int = SMALL_BYTES, hot_words: int = HOT_WORDS) -> DataFrame:
    """All pairs of ``words`` (word, n; each word once, not empty) that differ
    by exactly one inserted, deleted or replaced code point, each pair once:
    word, n, near and near_n."""
    python_workers(words.sparkSession)
    prefixes = _prefixes(words)                       # made anew where it is read: cheaper than a stored table
    nodes = stored(prefixes.groupBy(*_KEY).agg(
        F.min("after").alias("_a"), F.max("after").alias("_b"), F.count(F.lit(1)).alias("below"),
        F.max(F.when(F.col("after") < 0, F.col("n"))).alias("node_n"), F.min(_spokesman(F.col("size"), F.col("w1"))).alias("speaks"))
        .filter(F.col("_a") != F.col("_b")).drop("_a", "_b"), "nodes")
    own = _Table(nodes, small_bytes, hot_words).meet(prefixes.drop("after"), _KEY, keep_below=True)
    paths = stored(_paths(_prefixes(words, whole=True), own), "paths")
    edges = _Table(stored(_edges(paths), "edges"), small_bytes, hot_words)
    found, frontier = _entered(paths, edges)
    while not frontier.isEmpty():
        moved = stored(_follow(frontier, edges), "level")
        found.append(_ended(moved))
        frontier = _going_on(moved)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _spokesman(size: Column, w1: Column) -> Column:
    """A number by which one of the shortest words below a node is chosen.  The
    shortest have the most nodes of all that pass there."""
    return F.shiftleft(size.cast("long"), 40) + F.shiftrightunsigned(w1, 24)


def _paths(ends: DataFrame, own: DataFrame) -> DataFrame:
    """For each word and side its nodes and its leaf by depth, with the word's
    number for ``_spokesman``.  Words without nodes are left out."""
    nothing = F.lit(None).cast("long")
    step = F.struct("depth", *_KEY, "below", "node_n", "speaks").alias("_s")
    row = ["w1", "w2", "side"]
    leaves = ends.select(*row, "word", "n", _spokesman(F.col("size"), F.col("w1")).alias("code"),
                         F.struct("depth", *_KEY, F.lit(0).cast("long").alias("below"), nothing.alias("node_n"),
                                  nothing.alias("speaks")).alias("_s"))
    return (own.select(*row, F.lit(None).cast("string").alias("word"), nothing.alias("n"), nothing.alias("code"), step)
            .unionByName(leaves).groupBy(*row)
            .agg(F.max("word").alias("word"), F.max("n").alias("n"), F.max("code").alias("code"),
                 F.array_sort(F.collect_list("_s")).alias("path"))
            .filter(F.size("path") > 1).drop("w1", "w2"))


def _ends_at(depth: Column) -> Column:
    """The word that a node at ``depth`` of ``word`` spells."""
    return F.when(F.col("side") == 0, F.col("word").substr(F.lit(1), depth)).otherwise(
        F.col("word").substr(F.length("word") - depth + 1, depth))


def _edges(paths: DataFrame) -> DataFrame:
    """The compressed trie's edges: parent key, first letter, label, child's
    key (c1, c2), the word that ends at the child with its count, and the
    number of words ``below`` the parent.  An edge that many words share comes
    from the child's spokesman; one to a word's end from that word."""
    size = F.size("path")
    pairs = paths.select("word", "n", "side", "code", F.explode(F.arrays_zip(
        F.slice("path", 1, size - 1).alias("u"), F.slice("path", 2, size - 1).alias("v"))).alias("_e"))
    u, v = F.col("_e.u"), F.col("_e.v")
    # a word that ends at a node has that place twice, the leaf (0 below) first
    leaf = v["speaks"].isNull()
    label = _turned(F.col("side"), F.col("word")).substr(u["depth"] + 1, v["depth"] - u["depth"])
    return (pairs.filter((u["depth"] < v["depth"]) & (leaf | (v["speaks"] == F.col("code"))))
            .select(u["k1"].alias("k1"), u["k2"].alias("k2"), u["below"].alias("below"), label.alias("label"),
                    v["k1"].alias("c1"), v["k2"].alias("c2"),
                    F.when(leaf, F.col("word")).when(v["node_n"].isNotNull(), _ends_at(v["depth"])).alias("child_word"),
                    F.when(leaf, F.col("n")).otherwise(v["node_n"]).alias("child_n"))
            .withColumn("first", F.substring("label", 1, 1)))


def _entered(paths: DataFrame, edges: _Table) -> tuple[list, DataFrame]:
    """The first level: states leave their word's own nodes with their edit."""
    size, depth = F.length("word"), F.col("_s.depth")
    beyond = F.when(F.col("side") == 0, 2 * depth >= size - 1).otherwise(2 * depth > size - 1)
    own = (paths.select("word", "n", "side", F.explode(F.filter("path", lambda s: s["speaks"].isNotNull())).alias("_s"))
           .filter(beyond & (depth < size)))
    shorter = (own.filter((depth == size - 1) & F.col("_s.node_n").isNotNull())
               .select("word", "n", _ends_at(depth).alias("near"), F.col("_s.node_n").alias("near_n")))
    rest = _turned(F.col("side"), F.col("word")).substr(depth + 1, size)
    states = own.select("word", "n", rest.alias("rest"), "_s.k1", "_s.k2")
    first, second = F.substring("rest", 1, 1), F.substring("rest", 2, 1)
    after, long = _letters(F.col("rest"), 2), F.length("label")
    replaced = (F.col("first") > first) & F.startswith(after, _letters(F.col("label"), 2))
    deleted = (second != first) & (F.col("first") == second) & F.startswith(after, F.col("label"))
    left = F.array_compact(F.array(F.when(replaced, F.col("rest").substr(long + 1, F.length("rest"))),
                                   F.when(deleted, after.substr(long + 1, F.length("rest")))))
    met = edges.meet(states, _KEY).filter(replaced | deleted)
    moved = stored(met.select("word", "n", F.explode(left).alias("rest"), F.col("c1").alias("k1"), F.col("c2").alias("k2"),
                              "child_word", "child_n"), "level")
    return [shorter, _ended(moved)], _going_on(moved)


def _follow(states: DataFrame, edges: _Table) -> DataFrame:
    """States whose edit is used move along the edge that spells their letters."""
    states = states.withColumn("first", F.substring("rest", 1, 1))
    met = edges.meet(states, [*_KEY, "first"])
    return _moved(met.filter(F.startswith(F.col("rest"), F.col("label"))))


def _moved(met: DataFrame) -> DataFrame:
    rest = F.col("rest").substr(F.length("label") + 1, F.length("rest"))
    return met.select("word", "n", rest.alias("rest"), F.col("c1").alias("k1"), F.col("c2").alias("k2"), "child_word", "child_n")


def _ended(moved: DataFrame) -> DataFrame:
    return (moved.filter((F.col("rest") == "") & F.col("child_word").isNotNull())
            .select("word", "n", F.col("child_word").alias("near"), F.col("child_n").alias("near_n")))


def _going_on(moved: DataFrame) -> DataFrame:
    return moved.filter(F.col("rest") != "").select("word", "n", "rest", *_KEY)


# ------------------------------------------------------------------- forms

def variants(words: DataFrame, ratio: int = RATIO, small_bytes: int = SMALL_BYTES,
             hot_words: int = HOT_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of ``words`` (word,
    n; each word once).

    Words are near when exactly one code point is inserted, deleted or
    replaced.  The form is the near word with the largest n, of equal ones the
    smallest in code-point order, where that n is at least ``ratio`` (over 1)
    times the word's; else null.  The root is reached from the word along the
    forms.  n_near is 0 and root the word itself where there is none.  Null and
    empty words, and words without n, are left out; other columns are not
    read; an empty table gives no rows."""
    words = cut(words.select("word", "n").filter((F.col("word") != "") & F.col("n").isNotNull()))
    pairs = cut(neighbours(words, small_bytes, hot_words))
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("_n"), F.col("near").alias("near")))
    near = (both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_b"))
            .select("word", "n_near", F.when(-F.col("_b._n") >= ratio * F.col("n"), F.col("_b.near")).alias("form"),
                    (-F.col("_b._n")).alias("_n")))
    near = cut(near.withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("_n"))).drop("_n"))
    roots = _roots(near.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """The last of the chain that ``forms`` (word, root) lead along.  Every
    round doubles the steps taken; counts at least double along a chain, so it
    is short and has an end."""
    forms = cut(forms)
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        forms = cut(forms.join(onward, "root", "left")
                    .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_on")))
        if forms.filter("_on").isEmpty():
            return forms.drop("_on")
        forms = forms.drop("_on")
