"""Conversations from reply trees.

Messages point to the message they answer.  Self-joins that double their reach
in each round find the root, depth and score of every path; leaves are ranked
by their path's score within the tree; and the chosen paths are walked from the
leaf with the same doubled jumps, so a tree of depth d takes about log2(d)
joins.  Each chosen path becomes one text.

The text marks turns with control strings.  Where such a string stands in a
message, a backslash after its first character breaks it up, and backslashes
are doubled, so the message can be read back exactly."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, python_workers

# Fixed values of the template: "### role: text</turn>\n".
HEAD = "###"
COLON = ": "
END = "</turn>"
CONTROLS = (HEAD, END)
_BREAK = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_ROLE_BREAK = re.compile(":")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_ROLE = re.compile(r"### ((?:\\.|[^\\:])*): ", re.DOTALL)


def escape(text: str) -> str:
    """``text`` without any control string in it."""
    return _BREAK.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Iterable[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[int], list[int]]:
    """One conversation as text, with the starts and ends (code points) of the
    texts whose role is ``learn``: the loss mask."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head = f"{HEAD} " + _ROLE_BREAK.sub(lambda m: "\\:", escape(role)) + COLON
        body = escape(text)
        if role == learn:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += (head, body, END, "\n")
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), starts, ends


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for block in formatted.split(END + "\n")[:-1]:
        head = _ROLE.match(block)
        turns.append((unescape(head[1]), unescape(block[head.end():])))
    return turns


def paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """Root-to-leaf paths of the trees in ``messages`` (message_id, parent_id,
    score): the ``keep`` best of each tree, or all.

    Returns root_id, leaf_id, rank, path_score, message_id and position (from
    0 at the root), one row per message of a chosen path.  A path's score is
    the mean score of its messages (null scores count as 0); ties go to the
    smaller leaf id.  A message whose parent is null or absent is a root.  Of
    repeated ids one row counts, the smallest.  Messages of a cycle have no
    root and belong to no path.  Rows without an id are left out."""
    nodes = (messages.filter(F.col("message_id").isNotNull()).groupBy("message_id")
             .agg(F.min(F.struct("parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("_m"))
             .select("message_id", "_m.parent_id", "_m.score"))
    nodes = cut(nodes)
    known = nodes.select(F.col("message_id").alias("_known"))
    reach = cut(nodes.join(known, F.col("parent_id") == F.col("_known"), "left")
                .select("message_id", F.col("_known").alias("anc"), F.coalesce("_known", "message_id").alias("top"),
                        F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")))
    jumps = []
    for _ in range(max(1, math.ceil(math.log2(max(nodes.count(), 2)))) + 1):
        if reach.filter(F.col("anc").isNotNull()).isEmpty():
            break
        jumps.append(reach.select(F.col("message_id").alias("_from"), F.col("anc").alias("_to")).filter(F.col("_to").isNotNull()))
        far = reach.select(F.col("message_id").alias("_id"), F.col("anc").alias("_anc"), F.col("top").alias("_top"),
                           F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        # only messages that have not met their root yet take part
        further = (reach.filter(F.col("anc").isNotNull()).join(far, F.col("anc") == F.col("_id"))
                   .select("message_id", F.col("_anc").alias("anc"), F.col("_top").alias("top"),
                           (F.col("total") + F.col("_total")).alias("total"),
                           (F.col("depth") + F.col("_depth")).alias("depth")))
        reach = cut(reach.filter(F.col("anc").isNull()).unionByName(further))
    parents = nodes.select(F.col("parent_id").alias("_parent")).filter(F.col("_parent").isNotNull()).distinct()
    leaves = (reach.filter(F.col("anc").isNull())
              .join(parents, F.col("message_id") == F.col("_parent"), "left_anti")
              .select(F.col("top").alias("root_id"), F.col("message_id").alias("leaf_id"),
                      (F.col("total") / F.col("depth")).alias("path_score"), "depth"))
    best = Window.partitionBy("root_id").orderBy(F.col("path_score").desc(), "leaf_id")
    chosen = leaves.withColumn("rank", F.row_number().over(best))
    if keep is not None:
        chosen = chosen.filter(F.col("rank") <= keep)
    walk = chosen.select("root_id", "leaf_id", "rank", "path_score", F.col("leaf_id").alias("message_id"),
                         (F.col("depth") - 1).alias("position"))
    for k in range(len(jumps) - 1, -1, -1):
        stay = F.struct(F.col("message_id").alias("m"), F.col("position").alias("p"))
        go = F.struct(F.col("_to").alias("m"), (F.col("position") - (1 << k)).alias("p"))
        walk = (walk.join(jumps[k], F.col("message_id") == F.col("_from"), "left")
                .select("root_id", "leaf_id", "rank", "path_score", F.explode(
                    F.when(F.col("_to").isNull(), F.array(stay)).otherwise(F.array(stay, go))).alias("_s"))
                .select("root_id", "leaf_id", "rank", "path_score", F.col("_s.m").alias("message_id"),
                        F.col("_s.p").alias("position")))
    return walk


def conversations(messages: DataFrame, keep: int | None = 1, learn: str = "assistant") -> DataFrame:
    """The chosen paths of ``messages`` (message_id, parent_id, role, text,
    score) as formatted conversations.

    Returns root_id, leaf_id, rank, path_score, formatted, loss_starts and
    loss_ends.  Null roles and texts are empty; an empty table gives no rows;
    other columns are not read.  See ``paths`` for ties, repeated ids and
    broken trees."""
    python_workers(messages.sparkSession)
    chosen = paths(messages.select("message_id", "parent_id", "score"), keep)
    texts = (messages.filter(F.col("message_id").isNotNull()).groupBy(F.col("message_id").alias("_id"))
             .agg(F.min(F.struct("parent_id", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))).alias("_m")))
    turns = F.sort_array(F.collect_list(F.struct("position", "_m.role", "_m.text")))
    whole = (chosen.join(texts, F.col("message_id") == F.col("_id"))
             .groupBy("leaf_id").agg(F.first("root_id").alias("root_id"), F.first("rank").alias("rank"),
                                     F.first("path_score").alias("path_score"), turns.alias("_turns")))

    @F.pandas_udf("formatted string, loss_starts array<long>, loss_ends array<long>")
    def to_text(roles: pd.Series, texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([render(zip(r, t), learn) for r, t in zip(roles, texts)],
                            columns=["formatted", "loss_starts", "loss_ends"])

    return (whole.select("root_id", "leaf_id", "rank", "path_score",
                         to_text(F.col("_turns.role"), F.col("_turns.text")).alias("_f"))
            .select("root_id", "leaf_id", "rank", "path_score", "_f.*"))


def linear_threads(turns: DataFrame) -> DataFrame:
    """Messages of threads whose rows answer each other in turn: each row of
    ``turns`` (conv_id, turn, role, text) answers the one before it.  Adds
    message_id, parent_id and score (the text's length).  Rows of equal turn
    stand in the order of role and text, null turns first; a null conv_id is a
    thread of its own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    name = lambda n: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), n)
    at = F.col("_at")
    return (turns.select("conv_id", "role", "text", F.row_number().over(order).alias("_at"))
            .select("conv_id", "role", "text", name(at).alias("message_id"),
                    F.when(at > 1, name(at - 1)).alias("parent_id"),
                    F.char_length(F.coalesce("text", F.lit(""))).alias("score")))


def digests(formatted: Column, starts: Column, ends: Column) -> Column:
    """What a formatted conversation holds, read back from its text: its turns
    and their digest, the text under the loss mask (``starts`` and ``ends``) and
    its digest, and its length, all in code points.  A conversation without a
    learnt turn has an empty mask; empty roles and texts count as they are.
    None of the three is null."""
    import hashlib

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def read(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for text, first, last in zip(texts, starts, ends):
            turns = read_back(text)
            loss = "".join(unescape(text[a:b]) for a, b in zip(first, last))
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (whole, loss)]
            rows.append((len(turns), sha[0], len(loss), sha[1], len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return read(formatted, starts, ends)
