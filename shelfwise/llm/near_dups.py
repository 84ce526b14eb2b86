"""Near-duplicates by order MinHash with alignment.

A text's k-mers are labelled with their occurrence, so that repeats count, and
each of ``SKETCHES`` hash functions samples the ``PICKS`` labelled k-mers with
the smallest values.  The sample keeps the order that they have in the text,
so two texts agree on it only where the same k-mers stand in the same order:
the sketch follows edit similarity, not just shared vocabulary.  K-mers are
three words, short enough for scattered edits: of pairs whose words are 80 %
alike about one in a hundred shares no sketch, of those at 85 % about none
(measured, see the README).

Texts that agree on a sketch are a group, and a banded alignment of the words
decides on its links.  First every text meets the smallest text of a group, so
a group of n near copies costs n - 1 alignments; then the smallest of those
that it rejected leads, and so on for a few rounds.  Of groups that are still in
several components by then all members meet, apart from those that are linked
already: only such of like length, in blocks of profiles of their words, which
drop pairs that cannot align.  Of the pairs left each text's few likeliest are
aligned first, then those whose texts are still in different components.  That
step compares up to n ** 2 / 2 profiles for a group of n unlike texts of one
length, and aligns as many where the words are alike and their order is not.  Classes are the connected components of
the links; exact copies are one text throughout."""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .alignment import within
from .common import broadcast_if_small, python_workers, stored, text_key, whole_row
from .components import components

K = 3
PICKS = 2
SKETCHES = 48
#: Least share of words that an alignment leaves alone.
SIMILARITY = 0.8

#: Buckets of a text's profile, of the wide one of a text in an open group (a
#: multiple), and about how many texts meet at a time.
BUCKETS = 128
WIDE = 2048
BLOCK = 128
#: Rounds of leaders before all members of open groups meet.
ROUNDS = 3
#: Pairs of a text, those that share most sketches, that are aligned before the
#: others of open groups.
LIKELIEST = 4
#: Texts aligned with one copy of their leader's text.
STAR = 2000
#: A place in a text takes so many low bits of a sketch's values.
PLACE_BITS = 31

_WORD = re.compile(r"\w+")
_NO = np.uint64(0xFFFFFFFFFFFFFFFF)
_MIX = np.uint64(0x9E3779B97F4A7C15)


#: In ASCII texts: what is no letter, digit or underscore becomes a space.
_ASCII = str.maketrans({chr(c): " " for c in range(128) if not (chr(c).isalnum() or chr(c) == "_")})


def word_list(text: str) -> list[str]:
    """Lower-cased words; texts without letters and digits use their
    white-space-separated parts."""
    lowered = text.lower()
    found = lowered.translate(_ASCII).split() if lowered.isascii() else _WORD.findall(lowered)
    return found or lowered.split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def candidate_keys(texts: list[str | None], k: int = K, picks: int = PICKS,
                   sketches: int = SKETCHES) -> list[list[int]]:
    """For each text its sketches as numbers; none for texts without words."""
    return _candidates(*_word_hashes(texts), k, picks, sketches)


def _candidates(h: np.ndarray, lengths: np.ndarray, k: int = K, picks: int = PICKS,
                sketches: int = SKETCHES) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in lengths]
    chosen = np.flatnonzero(lengths > 0)
    if len(chosen):
        starts = np.cumsum(lengths) - lengths
        keys = _sketches(h, starts[chosen], lengths[chosen], k, picks, sketches)
        for i, row in zip(chosen.tolist(), keys.view(np.int64).tolist()):
            out[i] = row
    return out


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words in a row, and how many each text has."""
    words, counts = [], []
    for text in texts:
        found = word_list(text) if text else []
        words += found
        counts.append(len(found))
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    vocabulary = np.empty(len(number), object)
    vocabulary[:] = list(number)
    hashes = pd.util.hash_array(vocabulary, categorize=False) if number else np.empty(0, np.uint64)
    return hashes[ids], np.array(counts, np.int64)


def _labelled_mers(h: np.ndarray, starts: np.ndarray, lengths: np.ndarray, k: int) -> tuple:
    """The k-mers of each text as numbers (of a text under k words: all its
    words as one), the same labelled with how often the k-mer stood before in
    its text, how many each text has and the text of each."""
    rolled = np.concatenate((h, np.zeros(k, np.uint64)))
    mers = np.zeros(len(h), np.uint64)
    for j in range(k):
        mers = mers * _MIX + _mix(rolled[j:j + len(h)])
    counts = np.maximum(lengths - k + 1, 1)
    first = np.cumsum(counts) - counts
    mers = mers[np.repeat(starts - first, counts) + np.arange(counts.sum())]
    for i in np.flatnonzero(lengths < k):
        value = np.zeros(1, np.uint64)
        for x in h[starts[i]:starts[i] + lengths[i]]:
            value = value * _MIX + _mix(np.array([x], np.uint64))
        mers[first[i]] = value[0] ^ np.uint64(lengths[i])
    doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    of_doc = _mix(mers + _mix(doc * _MIX))
    order = np.argsort(of_doc, kind="stable")
    same = np.concatenate(([False], of_doc[order[1:]] == of_doc[order[:-1]]))
    places = np.arange(len(order))
    run = np.maximum.accumulate(np.where(same, 0, places))
    before = np.empty(len(order), np.uint64)
    before[order] = (places - run).astype(np.uint64)
    return mers, _mix(mers + before * _MIX), counts, doc.astype(np.int64)


def _sketches(h: np.ndarray, starts: np.ndarray, lengths: np.ndarray, k: int, picks: int, sketches: int) -> np.ndarray:
    """Sketches of the texts at ``starts`` of the word hashes ``h``, a row each."""
    mers, labelled, counts, _ = _labelled_mers(h, starts, lengths, k)
    first = np.cumsum(counts) - counts
    place = (np.arange(len(mers)) - np.repeat(first, counts)).astype(np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    padded = np.append(mers, np.uint64(0))
    keys = np.empty((len(counts), sketches), np.uint64)
    rng = np.random.default_rng(20)
    for s in range(sketches):
        xor, odd = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
        # the place in the low bits: the least value tells where it stands, and of equal ones the earlier wins
        values = (((labelled ^ xor) * (odd | np.uint64(1))) & ~low) | place
        spots = np.full((picks, len(counts)), len(values), np.int64)
        for p in range(picks):
            usable = np.flatnonzero(counts > p)
            at = first[usable] + (np.minimum.reduceat(values, first)[usable] & low).astype(np.int64)
            spots[p, usable] = at
            values[at] = _NO
        spots.sort(axis=0)                            # the order in the text
        key = np.full(len(counts), 1000 * k + s + 1, np.uint64)
        for p in range(picks):
            key = _mix(key * _MIX + padded[spots[p]])
        keys[:, s] = key
    return keys


def similar(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    """Whether the words of two texts align with edits to at most the given
    rest of the longer one."""
    return _similar(word_list(a), word_list(b), similarity)


def _similar(x: list[str], y: list[str], similarity: float) -> bool:
    return within(x, y, int((1 - similarity) * max(len(x), len(y)) + 1e-9))


def sketched(text: Column) -> Column:
    """A struct of each text's candidate ``keys`` and its ``profile``."""
    @F.pandas_udf("keys array<long>, profile binary")
    def make(texts: pd.Series) -> pd.DataFrame:
        h, lengths = _word_hashes(texts.tolist())
        return pd.DataFrame({"keys": _candidates(h, lengths), "profile": _profile_bytes(h, lengths)})

    return make(text)


def _aligned(a: Column, b: Column, similarity: float) -> Column:
    @F.pandas_udf("boolean")
    def check(left: pd.Series, right: pd.Series) -> pd.Series:
        out, last, words = [], None, []
        for x, y in zip(left, right):
            if y != last:                             # rows of one leader follow each other
                last, words = y, word_list(y)
            out.append(_similar(word_list(x), words, similarity))
        return pd.Series(out, dtype=bool)

    return check(a, b)


def _links(pairs: DataFrame, distinct: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """u and v of the ``pairs`` (node, leader; each once) whose ``texts`` (node,
    text) align.  Only pairs that may align by their profiles are looked at."""
    profiles = distinct.select("node", F.col("_profile").alias("_a"))
    close = stored(pairs.join(profiles, "node").join(profiles.toDF("leader", "_b"), "leader")
                   .filter(_close(F.col("_a"), F.col("_b"), similarity)).select("node", "leader"), "close")
    return _alignments(close, texts, similarity)


def _alignments(close: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """u and v of the pairs ``close`` (node, leader; each once) that align.
    A text moves once for each of its leaders; a leader's own text once for every
    ``STAR`` of its pairs, so a leader of very many has them in many tasks."""
    stars = close.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("_of"))
    dealt = close.join(stars, "leader").withColumn("_part", F.pmod(F.xxhash64("node"), F.col("_of")).cast("int"))
    wanted = dealt.select("node", "leader", "_part", F.lit(False).alias("_leads")).unionByName(
        stars.select(F.col("leader").alias("node"), "leader", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)).alias("_part"),
                     F.lit(True).alias("_leads")))
    wanted = stored(wanted, "wanted")
    moved = texts.join(broadcast_if_small(wanted, wanted.count()), "node")
    key = ["leader", "_part"]
    met = (moved.filter(~F.col("_leads")).select("node", *key, F.col("text").alias("_a"))
           .join(moved.filter("_leads").select(*key, F.col("text").alias("_b")), key))
    return (met.filter(_aligned(F.col("_a"), F.col("_b"), similarity))
            .select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct())


def _close(a: Column, b: Column, similarity: float) -> Column:
    """Whether two texts may align by their profiles."""
    @F.pandas_udf("boolean")
    def check(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype=bool)
        x, n = _profiles(left.tolist())
        y, m = _profiles(right.tolist())
        limit = ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)
        return pd.Series(_least_edits(x - y, n - m) <= limit)

    return check(a, b)


def _least_edits(surplus: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Edits that pairs of texts need at least, by the ``surplus`` of one text's
    buckets over the other's and by how many words ``more`` it has.  Words that
    one side lacks need an edit each.  Buckets end at 255 and numbers of words do
    not, so what either side lacks follows from the other's as well."""
    over = np.maximum(surplus, 0).sum(axis=1)
    under = over - surplus.sum(axis=1)
    return np.maximum(np.maximum(over, under + more), np.maximum(under, over - more))


def profile(text: str) -> bytes:
    """How many of the text's words fall into each of ``BUCKETS``, at most 255,
    then the number of words.  An edit changes two buckets by one at most."""
    return _profile_bytes(*_word_hashes([text]))[0]


def _profile_bytes(h: np.ndarray, lengths: np.ndarray, size: int = BUCKETS) -> list[bytes]:
    buckets = (_mix(h) % np.uint64(size)).astype(np.int64)
    ends = np.cumsum(lengths)
    return [np.minimum(np.bincount(buckets[end - n:end], minlength=size), 255).astype(np.uint8).tobytes()
            + np.int64(n).astype("<i8").tobytes() for end, n in zip(ends, lengths)]


def _profiles(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = len(items[0]) - 8 if items else BUCKETS
    data = np.frombuffer(b"".join(items), np.uint8).reshape(len(items), size + 8)
    return data[:, :size].astype(np.int16), data[:, size:].copy().view("<i8")[:, 0]


def _wide(text: Column) -> Column:
    """A text's wide ``profile`` and its number of ``words``."""
    @F.pandas_udf("profile binary, words long")
    def make(texts: pd.Series) -> pd.DataFrame:
        h, lengths = _word_hashes(texts.tolist())
        return pd.DataFrame({"profile": _profile_bytes(h, lengths, WIDE), "words": lengths})

    return make(text)


def shared_keys(a: list[np.ndarray], b: list[np.ndarray], key: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text of ``a`` and each of ``b`` (the keys of all groups that they
    are in, ``key`` among them): how many they share, and whether ``key`` is the
    smallest of these.  So two texts meet in one group only."""
    keys = np.intersect1d(np.concatenate(a), np.concatenate(b))

    def marks(texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), len(keys)), np.float32)
        for row, own in zip(out, texts):
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            row[at[keys[at] == own]] = 1
        return out

    x, y = marks(a), marks(b)
    smaller = int(np.searchsorted(keys, key))
    return (x @ y.T).astype(np.int64), x[:, :smaller] @ y[:, :smaller].T == 0


def may_align(a: list[bytes], b: list[bytes], roots_a: np.ndarray, roots_b: np.ndarray,
              similarity: float = SIMILARITY, meet: np.ndarray | None = None) -> list[tuple[np.ndarray, int]]:
    """For each text of ``b`` that may align with texts of ``a`` (profiles) of
    another component: their places in ``a``, and its own; only of those that
    ``meet``, where given.  No other pair that aligns is left out: words in a
    bucket beyond the other's need an edit each.  Of wide profiles the buckets
    are looked at together first, then each."""
    x, n = _profiles(a)
    y, m = _profiles(b)
    folded = [v.reshape(len(v), BUCKETS, -1).sum(axis=2, dtype=np.int16) for v in (x, y)]
    levels = [folded, (x, y)] if x.shape[1] > BUCKETS else [(x, y)]
    out = []
    for j in range(len(b)):
        longer = np.maximum(n, m[j])
        limit = ((1 - similarity) * longer + 1e-9).astype(np.int64)
        apart = (roots_a != roots_b[j]) & (np.abs(n - m[j]) <= limit)
        at = np.flatnonzero(apart if meet is None else apart & meet[:, j])
        for left, right in levels:
            if len(at):
                at = at[_least_edits(left[at] - right[j], n[at] - m[j]) <= limit[at]]
        if len(at):
            out.append((at, j))
    return out


def _pairs_of(similarity: float):
    @F.pandas_udf("array<struct<node:long,leader:long,keys:long>>")
    def make(key: pd.Series, a: pd.Series, a_root: pd.Series, a_profile: pd.Series, a_keys: pd.Series,
             b: pd.Series, b_root: pd.Series, b_profile: pd.Series, b_keys: pd.Series) -> pd.Series:
        out = []
        for k, x, xr, xp, xk, y, yr, yp, yk in zip(key, a, a_root, a_profile, a_keys, b, b_root, b_profile, b_keys):
            shared, meet = shared_keys(list(xk), list(yk), k)
            found: dict = {}
            for at, j in may_align(list(xp), list(yp), np.asarray(xr), np.asarray(yr), similarity, meet):
                found.update({(max(int(x[i]), int(y[j])), min(int(x[i]), int(y[j]))): int(shared[i, j]) for i in at.tolist()})
            out.append([{"node": u, "leader": v, "keys": n} for (u, v), n in found.items()])
        return pd.Series(out)

    return make


def _open_groups(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (node, key) of the groups with more than one component, with
    the member's ``root``."""
    members = rows.join(roots, "node", "left").select("node", "key", F.coalesce("root", "node").alias("root"))
    open_ = (members.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), F.count(F.lit(1)).alias("_n"))
             .filter((F.col("_a") != F.col("_b")) & (F.col("_n") > 2)).select("key"))      # of two, one has been the leader
    return members.join(open_, "key")


def _unmet(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (node, leader) of ``members`` (node, key, root) that share a key,
    are not in one component and may align by their ``texts``' wide profiles,
    each once, with the number of ``keys`` that they share.  Wide profiles tell
    nearly all differing words apart; pairs with the same words in another order
    are left.

    Members are dealt into bands by their number of words, so that texts that
    may align lie in one band or in neighbouring ones, and bands into blocks of
    about ``BLOCK``.  A block meets itself, the others of its band and those of
    the next, each meeting by a key of its own: no group lies in one task, and
    only pairs that pass the profiles become rows.  Texts of several common
    groups are compared in that of the smallest key only."""
    keys = members.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    known = (texts.join(members.select("node").distinct(), "node", "left_semi").select("node", _wide(F.col("text")).alias("_w"))
             .select("node", "_w.profile", F.floor(F.log(F.greatest(F.col("_w.words"), F.lit(1))) / -math.log(similarity) + 1e-9)
                     .cast("int").alias("band")))
    members = stored(members.join(known.join(keys, "node"), "node"), "open")
    bands = members.groupBy("key", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_of"))
    following = bands.select("key", (F.col("band") - 1).alias("band"), F.col("_of").alias("_next"))
    before = bands.select("key", (F.col("band") + 1).alias("band"), F.col("_of").alias("_before"))
    bands = bands.join(following, ["key", "band"], "left").join(before, ["key", "band"], "left")
    block = F.pmod(F.xxhash64("node"), F.col("_of")).cast("int")
    item = F.struct("node", "root", "profile", "keys")
    blocks = stored(members.join(bands, ["key", "band"]).groupBy("key", "band", "_of", "_next", "_before", block.alias("block"))
                    .agg(F.collect_list(item).alias("m")), "blocks")

    def upto(n: Column, band: Column, first: Column | int = 0) -> Column:
        """(band, block) for the blocks from ``first`` below ``n``; none for null."""
        first = F.lit(first) if isinstance(first, int) else first
        return F.when(F.coalesce(n, F.lit(0)) > first, F.transform(
            F.sequence(first, n - 1), lambda i: F.struct(band.alias("band"), i.alias("block")))).otherwise(
            F.array().cast("array<struct<band:int,block:int>>"))

    here, band = F.struct("band", "block"), F.col("band")
    left = blocks.select("key", here.alias("_i"), F.explode(F.concat(
        upto(F.col("_of"), band, F.col("block") + 1), upto(F.col("_next"), band + 1))).alias("_j"), F.col("m").alias("a"))
    right = blocks.select("key", here.alias("_j"), F.explode(F.concat(
        upto(F.col("block"), band), upto(F.col("_before"), band - 1))).alias("_i"), F.col("m").alias("b"))
    alone = blocks.select("key", F.col("m").alias("a"), F.col("m").alias("b"))
    meetings = alone.unionByName(left.join(right, ["key", "_i", "_j"]).select("key", "a", "b"))
    return meetings.select(F.explode(_pairs_of(similarity)(
        "key", "a.node", "a.root", "a.profile", "a.keys", "b.node", "b.root", "b.profile", "b.keys")).alias("_p")).select("_p.*")


def _led(rows: DataFrame) -> DataFrame:
    """``rows`` (node, key) of groups of several with the group's smallest node
    as ``leader``.  Groups are combined before they move."""
    leaders = (rows.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") > 1).drop("_n"))
    return rows.join(leaders, "key")


def _apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (node, leader, ...) whose two are in different components."""
    both = (rows.join(roots.toDF("node", "_u"), "node", "left").join(roots.toDF("leader", "_v"), "leader", "left"))
    return both.filter(F.coalesce("_u", "node") != F.coalesce("_v", "leader")).drop("_u", "_v")


def _similar_roots(shared: DataFrame, distinct: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """node and root of the components of all links within the groups of
    ``shared`` (node, key, leader)."""
    pairs = shared.filter(F.col("node") != F.col("leader"))
    first = stored(pairs.groupBy("node").agg(F.min("leader").alias("leader")), "first")
    links = stored(_links(first, distinct, texts, similarity), "links")
    roots = components(links)
    # every text has met the smallest of its leaders; then the others that it is apart from, and the leaders of the rejected
    pairs = stored(_apart(pairs.select("node", "leader").distinct().join(first, ["node", "leader"], "left_anti"), roots), "pairs")
    tested, rows = first, shared
    for _ in range(ROUNDS):
        if not pairs.isEmpty():
            links = stored(_links(pairs, distinct, texts, similarity), "links")
            roots = components(links.unionByName(roots.toDF("u", "v")))
            tested = tested.unionByName(pairs)
        rows = stored(_led(_apart(rows, roots).select("node", "key")), "rejected")
        pairs = stored(_apart(rows.filter(F.col("node") != F.col("leader")).select("node", "leader").distinct(), roots)
                       .join(tested, ["node", "leader"], "left_anti"), "pairs")
        if pairs.isEmpty():
            break
    members = stored(_open_groups(shared.select("node", "key"), roots), "members")
    if members.isEmpty():
        return roots
    # these have passed wide profiles, so the narrow ones are not looked at again
    rest = stored(_unmet(members, texts, similarity).join(tested, ["node", "leader"], "left_anti"), "unmet")
    if rest.isEmpty():
        return roots
    order = Window.partitionBy("node").orderBy(F.desc("keys"), "leader")
    likeliest = stored(rest.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= LIKELIEST)
                       .select("node", "leader"), "likeliest")
    links = stored(_alignments(likeliest, texts, similarity), "links")
    roots = components(links.unionByName(roots.toDF("u", "v")))
    rest = stored(_apart(rest.select("node", "leader").join(likeliest, ["node", "leader"], "left_anti"), roots), "apart")
    if rest.isEmpty():
        return roots
    return components(_alignments(rest, texts, similarity).unionByName(roots.toDF("u", "v")))


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """One row per distinct text: k1, k2, doc_id (smallest), copies, root (the
    class as a number) and class_id (its smallest doc_id)."""
    python_workers(docs.sparkSession)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", *text_key(F.col("text")), "text")
    distinct = stored(texts.withColumn("_s", sketched(F.col("text"))).groupBy("k1", "k2")
                      .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
                           F.first("_s.keys").alias("_keys"), F.first("_s.profile").alias("_profile"))
                      .withColumn("node", F.monotonically_increasing_id()), "distinct")
    shared = stored(_led(distinct.select("node", F.explode("_keys").alias("key"))), "shared")
    # the texts of groups are stored once, one row each; what follows reads only these
    grouped = stored(distinct.select("node", "k1", "k2", F.col("doc_id").alias("_id"))
                     .join(shared.select("node").distinct(), "node", "left_semi"), "grouped")
    members = stored(texts.join(broadcast_if_small(grouped, grouped.count()), ["k1", "k2"])
                     .filter(F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "text"), "texts")
    roots = _similar_roots(shared, distinct.drop("_keys"), members, similarity)
    placed = (distinct.drop("_keys", "_profile").join(roots, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    # classes of one text need no join; the others' first ids are a table of their
    # own, so a large class is summed before it moves and split where it is joined
    first = stored(placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("_n"))
                   .filter(F.col("_n") > 1).drop("_n"), "classes")
    return (placed.join(broadcast_if_small(first, first.count()), "root", "left")
            .withColumn("class_id", F.coalesce("class_id", "doc_id")))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, exact_id and text_copies for every row of ``docs``
    (doc_id, text).

    ``class_id`` is the smallest doc_id of the row's class of near-duplicates,
    ``exact_id`` that of the rows with the same text, ``text_copies`` their
    number.  A null text is a class of its own; texts without words are in a
    class with their exact copies only.  Repeated rows are copies.  An empty
    table gives no rows; other columns are not read."""
    found = _classes(docs, similarity).select("k1", "k2", "class_id", F.col("doc_id").alias("exact_id"), "copies")
    rows = docs.select("doc_id", F.col("text").isNull().alias("_none"), *text_key(F.col("text")))
    given = rows.filter(~F.col("_none")).join(found, ["k1", "k2"]).select(
        "doc_id", "class_id", "exact_id", F.col("copies").alias("text_copies"))
    none = rows.filter("_none").select("doc_id", F.col("doc_id").alias("class_id"),
                                       F.col("doc_id").alias("exact_id"), F.lit(1).cast("long").alias("text_copies"))
    return given.unionByName(none)


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with
    the smallest doc_id stays (one of them where that is repeated), and rows
    without a text stay.  Columns are those of ``docs``.

    Only texts that have copies or are not their class's first are joined."""
    classes = _classes(docs, similarity)
    first = F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull())
    # a class id may stand for two texts only where doc_ids repeat: one text stays
    kept = (classes.filter(first).groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("_k"))
            .select("_k.k1", "_k.k2", F.lit(True).alias("_stays")))
    touched = stored(classes.join(kept, ["k1", "k2"], "left")
                  .filter((F.col("copies") > 1) | F.col("_stays").isNull())
                  .select("k1", "k2", F.col("doc_id").alias("_keep"), F.coalesce("_stays", F.lit(False)).alias("_stays")), "touched")
    rows = (docs.select(whole_row(docs).alias("_doc"), *text_key(F.col("text")))
            .join(broadcast_if_small(touched, touched.count()), ["k1", "k2"], "left"))
    alone = rows.filter(F.col("_stays").isNull()).select("_doc.*")
    copied = (rows.filter("_stays").filter(F.col("_doc.doc_id").eqNullSafe(F.col("_keep")))
              .groupBy("k1", "k2").agg(F.first("_doc").alias("_doc")).select("_doc.*"))
    return alone.unionByName(copied)
