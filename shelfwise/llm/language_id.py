"""Language identification by sparse multinomial logistic regression.

Features are character n-grams, hashed into a fixed number of buckets and
weighted by TF-IDF.  The document frequencies cover all training rows: tasks sum
them per batch and Spark adds the sums.  The classifier is fitted on a bounded
sample of the training rows, drawn language by language so that a rare one is
learned at any size of the input, with follow-the-regularised-leader and elastic-net
penalties, which leaves most weights at zero; a part of the sample that it has
not seen calibrates its confidence by a temperature."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, python_workers, stored

#: Lengths of the character n-grams, and buckets for their hashes.
LENGTHS = (1, 2, 3)
BUCKETS = 1 << 14
#: Training texts that the classifier is fitted on, about, dealt out evenly to
#: the languages (their hashes choose them, copies once); a fifth of them
#: calibrates.  A language gets at least so many, or all its texts.  Their
#: features fill at most so many bytes.  The bounds do not grow with the input.
SAMPLE_ROWS = 4000
LEAST_PER_LANG = 50
SAMPLE_BYTES = 64 << 20
#: FTRL: learning rate and its smoothing, L1 and L2 penalties, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.05, 3
#: Label of texts without a letter.
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Labels, document frequencies' weights, and the classes' weights (only
    the buckets of ``rows`` have any)."""
    labels: list[str]
    idf: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def lookup(self) -> np.ndarray:
        """Weights of every bucket, IDF included."""
        full = np.zeros((len(self.idf), len(self.labels)))
        full[self.rows] = self.weights
        return full * self.idf[:, None]


def grams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every character n-gram of a whole text, lower-cased."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for n in LENGTHS:
        if len(codes) < n:
            break
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h ^ codes[j:len(codes) - n + 1 + j]) * _MIX
            h ^= h >> np.uint64(29)
        found.append(h & np.uint64(buckets - 1))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


def features(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their term frequencies, log-scaled."""
    counts = np.bincount(grams(text, buckets), minlength=buckets)
    at = np.flatnonzero(counts)
    return at, 1 + np.log(counts[at])


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def document_frequencies(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``docs`` over all rows of ``texts`` (text); the row of
    bucket -1 has the number of texts."""
    python_workers(texts.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(buckets, np.int64), 0
        for frame in frames:
            for text in frame["text"]:
                if text:
                    seen = np.zeros(buckets, bool)
                    seen[grams(text, buckets)] = True
                    total += seen
                    n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(at, -1), "docs": np.append(total[at], n)})

    return (texts.select("text").mapInPandas(count, "bucket long, docs long")
            .groupBy("bucket").agg(F.sum("docs").alias("docs")))


def _scores(lookup: np.ndarray, bias: np.ndarray, at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(tf * idf[at])
    return (tf @ lookup[at]) / norm + bias if norm else bias.copy()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(texts: list[str], labels: list[str], idf: np.ndarray) -> Model:
    """Fit on a bounded number of texts; every fifth calibrates."""
    return fit_features([features(t, len(idf)) for t in texts], labels, idf)


def fit_features(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], idf: np.ndarray) -> Model:
    """``fit`` on the texts' ``features``."""
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    k = len(names)
    z, n = np.zeros((len(idf), k)), np.zeros((len(idf), k))
    zb, nb = np.zeros(k), np.zeros(k)

    def solve(z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2))

    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 10 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~held)
    rng = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in rng.permutation(learn):
            at, tf = rows[i]
            x = tf * idf[at]
            norm = np.linalg.norm(x)
            if not norm:
                continue
            x = x / norm
            w, b = solve(z[at], n[at], L1, L2), solve(zb, nb, 0.0, 0.0)
            g = _softmax(x @ w + b)
            g[y[i]] -= 1.0
            step = x[:, None] * g
            sigma = (np.sqrt(n[at] + step ** 2) - np.sqrt(n[at])) / ALPHA
            z[at] += step - sigma * w
            n[at] += step ** 2
            zb += g - (np.sqrt(nb + g ** 2) - np.sqrt(nb)) / ALPHA * b
            nb += g ** 2
    weights, bias = solve(z, n, L1, L2), solve(zb, nb, 0.0, 0.0)
    used = np.flatnonzero(weights.any(axis=1))
    model = Model(names, idf, used, weights[used], bias, 1.0)
    check = np.flatnonzero(held)
    if len(check):
        lookup = model.lookup()
        logits = np.array([_scores(lookup, bias, *rows[i], idf) for i in check])
        model.temperature = _temperature(logits, y[check])
    return model


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the smallest loss on held-out logits, by golden
    section on its logarithm."""
    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())

    low, high, ratio = np.log(0.02), np.log(50.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> Model | None:
    """Fit on ``rows`` (text, lang); None without a usable row.

    Rows with null lang, or without a letter in the text, teach nothing."""
    spark = rows.sparkSession
    python_workers(spark)
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    frequencies = cut(document_frequencies(usable, buckets))
    table = frequencies.toPandas()                    # at most ``buckets`` + 1 rows
    total = int(table.loc[table["bucket"] == -1, "docs"].sum())
    if not total:
        return None
    docs = np.zeros(buckets)
    inside = table[table["bucket"] >= 0]
    docs[inside["bucket"].to_numpy()] = inside["docs"].to_numpy()
    idf = np.log((1 + total) / (1 + docs)) + 1
    sample = sampled(usable, sample_rows, buckets=buckets).orderBy("_h").toPandas()    # bounded by the parameters
    rows = [(np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(tf, "<f4").astype(float))
            for at, tf in zip(sample["at"], sample["tf"])]
    return fit_features(rows, sample["lang"].tolist(), idf) if len(sample) else None


def sampled(usable: DataFrame, sample_rows: int = SAMPLE_ROWS, least: int = LEAST_PER_LANG,
            sample_bytes: int = SAMPLE_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """A bounded sample of the rows (text, lang): _h, lang and the features of
    one text a row.  Every language gets an even part of ``sample_rows``, at
    least ``least`` texts, as long as it has them and they fit into its part of
    ``sample_bytes`` (its first one always does).  Copies are one text with its
    most frequent label; ties go to the first in the alphabet."""
    langs = cut(usable.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("_n")))
    known = langs.count()
    each = max(least, sample_rows // max(known, 1))
    slots = 1 << 30
    shares = langs.select("lang", F.least(F.lit(slots), (F.lit(float(each) * slots) / F.col("_n")).cast("long") + 1).alias("_share"))
    hashed = usable.withColumn("_h", F.xxhash64("text"))
    chosen = cut(hashed.join(broadcast_if_small(shares, known), "lang")
                 .filter(F.pmod("_h", F.lit(slots)) < F.col("_share")).select("_h").distinct())
    texts = (hashed.join(broadcast_if_small(chosen, chosen.count()), "_h")
             .groupBy("_h", "lang").agg(F.count(F.lit(1)).alias("_n"), F.first("text").alias("text")))
    labels = texts.groupBy("_h").agg(F.min_by("lang", F.struct((-F.col("_n")).alias("n"), "lang")).alias("lang"),
                                     F.first("text").alias("text"))
    found = labels.select("_h", "lang", _packed(F.col("text"), buckets).alias("_f")).select("_h", "lang", "_f.*")
    found = stored(found.withColumn("_bytes", F.octet_length("at") + F.octet_length("tf")), "sample")
    by_hash = Window.partitionBy("lang").orderBy("_h")           # of about ``each`` rows
    found = found.withColumns({"_rank": F.row_number().over(by_hash), "_sum": F.sum("_bytes").over(by_hash)})
    return (found.filter((F.col("_rank") == 1) | ((F.col("_rank") <= each + each // 4)
                                                  & (F.col("_sum") <= sample_bytes // max(known, 1))))
            .select("_h", "lang", "at", "tf"))


def _packed(text: Column, buckets: int) -> Column:
    """A text's ``features`` as bytes: bucket numbers and frequencies."""
    @F.pandas_udf("at binary, tf binary")
    def make(texts: pd.Series) -> pd.DataFrame:
        found = [features(t, buckets) for t in texts]
        return pd.DataFrame([(at.astype("<u4").tobytes(), tf.astype("<f4").tobytes()) for at, tf in found],
                            columns=["at", "tf"])

    return make(text)


def predictions(text: Column, model: Model | None) -> Column:
    """A struct of ``lang_pred`` and ``score`` (the calibrated probability) for
    each whole text; null texts and texts without a letter are ``UNKNOWN`` with
    score 0, as are all without a model."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lookup = model.lookup() if model else None
        out = []
        for t in texts:
            if model is None or not has_letter(t):
                out.append((UNKNOWN, 0.0))
                continue
            p = _softmax(_scores(lookup, model.bias, *features(t, len(model.idf)), model.idf) / model.temperature)
            best = int(np.argmax(p))                  # ties: the first label
            out.append((model.labels[best], float(p[best])))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return predict(text)


def identify(docs: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, learn (whether the row was for training), lang_pred and score for
    every row of ``docs`` (doc_id, text, lang).

    Only rows where ``learn_from`` holds teach, and only by their text and
    lang; a prediction reads the text alone.  Repeated rows get equal
    predictions; an empty table gives no rows; other columns are not read."""
    python_workers(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang", F.coalesce(learn_from, F.lit(False)).alias("_learn"))
    model = train(rows.filter("_learn"), sample_rows)
    return (rows.select("doc_id", F.col("_learn").alias("learn"), predictions(F.col("text"), model).alias("_p"))
            .select("doc_id", "learn", "_p.*"))
