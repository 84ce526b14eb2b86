"""Cross-entropy difference scoring.

Two bigram models over the tokens of one public vocabulary are matched: the same
order, vocabulary and smoothing, one counted on the target documents, the other
on all the rest.  A document's score is the mean over its tokens of the target
model's loss less the background model's loss, so low scores look like the
target.

Every document's tokens are counted.  Texts are encoded once; the ids go to the
checkpoint folder, two bytes each for vocabularies that allow it, and both the
counting and the scoring read them there.  Counts are summed per task before
the shuffle.  The table has one row per pair of tokens that occurs; while it is
small (counted, not guessed) each task gets it as a sorted array, beyond that
documents' pairs are joined with it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, python_workers
from .encoding import VOCABULARY, encoder

#: Ids of the vocabulary, and the id that stands before a text's first token.
IDS = 50257
START = IDS
WIDTH = IDS + 1
#: Weight of the unigram model in a bigram's probability, in tokens.
SMOOTHING = 20.0
#: Pairs that are sent to every task as an array of 24 bytes each.
BROADCAST_PAIRS = 2_000_000
#: Tokens that a task counts before it sums up.
CHUNK = 4_000_000


#: How ids are kept between the passes (``IDS`` is below 65,536).
_KEPT = "<u2"


def encoded(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` with their whole texts replaced by ``ids`` (little-endian)."""
    python_workers(rows.sparkSession)

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        ids = encoder(vocabulary).ids
        return pd.Series([ids(t).astype(_KEPT).tobytes() for t in texts])

    return rows.withColumn("ids", encode(F.col("text"))).drop("text")


def pairs_of(ids: bytes) -> np.ndarray:
    """Each token with the one before it, as one number."""
    tokens = np.frombuffer(ids, _KEPT).astype(np.int64)
    return np.concatenate(([START], tokens[:-1])) * WIDTH + tokens if len(tokens) else tokens


def count_pairs(rows: DataFrame) -> DataFrame:
    """``pair``, ``target`` and ``background``: how often each pair of tokens
    occurs in the rows (ids, is_target) of either kind."""
    python_workers(rows.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[list, list] = ([], [])
        size = 0

        def out() -> pd.DataFrame:
            codes = [np.concatenate(h) if h else np.empty(0, np.int64) for h in held]
            seen, at = np.unique(np.concatenate(codes), return_inverse=True)
            split = len(codes[0])
            return pd.DataFrame({"pair": seen, "background": np.bincount(at[:split], minlength=len(seen)),
                                 "target": np.bincount(at[split:], minlength=len(seen))})

        for frame in frames:
            for ids, is_target in zip(frame["ids"], frame["is_target"]):
                codes = pairs_of(ids)
                held[bool(is_target)].append(codes)
                size += len(codes)
            if size >= CHUNK:
                yield out()
                held, size = ([], []), 0
        if size:
            yield out()

    return (rows.select("ids", "is_target").mapInPandas(count, "pair long, background long, target long")
            .groupBy("pair").agg(F.sum("target").alias("target"), F.sum("background").alias("background")))


#: The two sides, in the order of all tables and arrays.
KINDS = ("target", "background")


def _loss(pair, context, token, total, known, own_pair, own_context, own_token, own_total, smoothing):
    """A model's loss on a pair, without a document's own counts: its bigram
    probability is the pair's count plus ``smoothing`` times the token's add-one
    unigram probability, over the context's count plus ``smoothing``.  Takes
    numbers, arrays or columns; the probability, not yet its logarithm."""
    unigram = (token - own_token + 1) / (total - own_total + known)
    return (pair - own_pair + smoothing * unigram) / (context - own_context + smoothing)


def totals_of(counts: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """Counts by the token before and by the token (at most one row for each
    id of the vocabulary) and the totals with the number of tokens ``known``."""
    both = counts.select(*KINDS, F.floor(F.col("pair") / WIDTH).alias("before"), F.pmod("pair", F.lit(WIDTH)).alias("token"))
    contexts = both.groupBy("before").agg(*[F.sum(k).alias(f"{k}_context") for k in KINDS])
    tokens = both.groupBy("token").agg(*[F.sum(k).alias(f"{k}_token") for k in KINDS])
    totals = tokens.agg(F.count(F.lit(1)).alias("known"), *[F.coalesce(F.sum(f"{k}_token"), F.lit(0)).alias(k) for k in KINDS])
    return contexts, tokens, totals.first().asDict()


def score(docs: DataFrame, is_target: Column, vocabulary: str = VOCABULARY,
          smoothing: float = SMOOTHING, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_tokens and score for every row of ``docs`` (doc_id, text);
    rows where ``is_target`` (over the columns of ``docs``) holds count for the
    target model, all others for the background, and none for its own score.

    Null and empty texts have no tokens and a null score.  Repeated rows count
    as often as they stand, also for each other, and score alike.  Without
    (other) target rows the target model is uniform over the tokens seen.  An
    empty table gives no rows."""
    spark = docs.sparkSession
    python_workers(spark)
    rows = cut(encoded(docs.select("doc_id", "text", F.coalesce(is_target, F.lit(False)).alias("is_target")), vocabulary))
    counts = cut(count_pairs(rows))
    contexts, tokens, totals = totals_of(counts)
    if counts.count() > broadcast_pairs:
        return _score_by_join(rows, counts, contexts, tokens, totals, smoothing)
    known = counts.select("pair", *KINDS).toArrow()
    order = np.argsort(known["pair"].to_numpy())
    pair = known["pair"].to_numpy()[order]
    by_pair = [known[k].to_numpy()[order] for k in KINDS]
    before, after = pair // WIDTH, pair % WIDTH
    by_context = [np.bincount(before, c, WIDTH).astype(np.int64) for c in by_pair]
    by_token = [np.bincount(after, c, WIDTH).astype(np.int64) for c in by_pair]
    model = spark.sparkContext.broadcast((pair, by_pair, by_context, by_token))

    @F.pandas_udf("n_tokens long, score double")
    def mean_difference(ids_of: pd.Series, targets: pd.Series) -> pd.DataFrame:
        pair, by_pair, by_context, by_token = model.value
        out = []
        for ids, is_target in zip(ids_of, targets):
            codes, n = np.unique(pairs_of(ids), return_counts=True)
            if not len(codes):
                out.append((0, None))
                continue
            before, token = codes // WIDTH, codes % WIDTH
            firsts, lasts = np.unique(before, return_inverse=True)[1], np.unique(token, return_inverse=True)[1]
            own = (n, np.bincount(firsts, n)[firsts], np.bincount(lasts, n)[lasts], n.sum())
            at = np.searchsorted(pair, codes)
            logs = [np.log(_loss(by_pair[k][at], by_context[k][before], by_token[k][token], totals[kind], totals["known"],
                                 *(own if (kind == "target") == is_target else (0, 0, 0, 0)), smoothing))
                    for k, kind in enumerate(KINDS)]
            out.append((int(n.sum()), float(((logs[1] - logs[0]) * n).sum() / n.sum())))
        return pd.DataFrame(out, columns=["n_tokens", "score"])

    return rows.select("doc_id", mean_difference(F.col("ids"), F.col("is_target")).alias("_s")).select("doc_id", "_s.*")


def _score_by_join(rows: DataFrame, counts: DataFrame, contexts: DataFrame, tokens: DataFrame, totals: dict,
                   smoothing: float) -> DataFrame:
    """The same scores with the pairs of every document joined to the table."""
    @F.pandas_udf("pair array<long>, n array<long>")
    def pairs(tokens: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([np.unique(pairs_of(ids), return_counts=True) for ids in tokens],
                            columns=["pair", "n"])

    numbered = cut(rows.select("doc_id", "is_target", pairs(F.col("ids")).alias("_p"))
                   .withColumn("_row", F.monotonically_increasing_id()))
    each = (numbered.select("_row", "is_target", F.explode(F.arrays_zip("_p.pair", "_p.n")).alias("_e"))
            .select("_row", "is_target", "_e.pair", "_e.n")
            .withColumns({"before": F.floor(F.col("pair") / WIDTH), "token": F.pmod("pair", F.lit(WIDTH))}))
    each = each.withColumns({"own_context": F.sum("n").over(Window.partitionBy("_row", "before")),
                             "own_token": F.sum("n").over(Window.partitionBy("_row", "token")),
                             "own_total": F.sum("n").over(Window.partitionBy("_row"))})
    met = each.join(counts, "pair").join(F.broadcast(contexts), "before").join(F.broadcast(tokens), "token")

    def log(kind: str) -> Column:
        mine = F.col("is_target") == F.lit(kind == "target")
        own = [F.when(mine, F.col(c)).otherwise(0) for c in ("n", "own_context", "own_token", "own_total")]
        return F.log(_loss(F.col(kind), F.col(f"{kind}_context"), F.col(f"{kind}_token"), F.lit(totals[kind]),
                           F.lit(float(totals["known"])), *own, F.lit(smoothing)))

    sums = (met.groupBy("_row").agg(F.sum("n").alias("n_tokens"),
                                    (F.sum(F.col("n") * (log("background") - log("target"))) / F.sum("n")).alias("score")))
    return (numbered.select("_row", "doc_id").join(sums, "_row", "left")
            .select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), "score"))


def labelled_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``is_target``: labelled of good quality and
    not toxic.  The narrow label table is broadcast while it is small."""
    good = cut(labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
               .agg(F.min("quality").alias("_q"), F.max("toxic").alias("_t"))
               .filter((F.col("_q") == 1) & (F.col("_t") == 0))
               .select(F.col("doc_id").alias("_good")))
    return (docs.select("doc_id", "text").join(broadcast_if_small(good, good.count()), F.col("doc_id") == F.col("_good"), "left")
            .select("doc_id", "text", F.col("_good").isNotNull().alias("is_target")))
