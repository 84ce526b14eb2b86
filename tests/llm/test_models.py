import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import lm_scoring
from shelfwise.llm.encoding import encoder
from shelfwise.llm.language_id import UNKNOWN, fit, grams, has_letter, identify, sampled
from shelfwise.llm.queries import op7_language, op8_lm_scoring


def test_grams_cover_the_whole_text():
    text = "Ab" + "c" * 5000 + "ÿ"
    assert len(grams(text)) == sum(len(text) - n + 1 for n in (1, 2, 3))
    assert len(grams("")) == 0 and len(grams("a")) == 1
    assert has_letter("1 é") and not has_letter("12 _-!") and not has_letter(None)


def test_penalties_leave_most_weights_at_zero():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdefgh" if i % 2 else "efghijkl"), 60)) for i in range(200)]
    model = fit(texts, ["x" if i % 2 else "y" for i in range(200)], np.ones(1 << 12))
    assert model.labels == ["x", "y"] and 0 < len(model.rows) < 1 << 11 and 0.02 <= model.temperature <= 50


def test_odd_rows(documents, clashes):
    rows = [(i, "der die das und " * 5 if i % 2 else "the of and to " * 5, "de" if i % 2 else "en", "s") for i in range(40)]
    rows += [(50, None, "en", "s"), (51, "", "de", "s"), (52, "12345 !!", None, "s"), (53, "the of and", None, "s"),
             (53, "the of and", None, "s"), (None, "der die das", "en", None), (54, "und " * 20_000, "xx", "s")]
    docs = documents(rows, clashes)
    got = {r.doc_id: r for r in identify(docs, F.col("doc_id") < 40).collect()}
    assert [got[i].lang_pred for i in (50, 51, 52)] == [UNKNOWN] * 3
    assert got[53].lang_pred == "en" and got[None].lang_pred == "de" and got[54].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert identify(docs, F.lit(True)).count() == len(rows)
    assert identify(docs.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in identify(docs, F.lit(False)).collect()} == {UNKNOWN}


def test_rare_language_is_learned(spark):
    """Two texts in 20,000 (0.01 %), with a sample of 200 texts."""
    rng = np.random.default_rng(5)
    words = {"aa": "the of and to in is that".split(), "bb": "der die das und zu den mit".split(), "cc": "ja wo nu ke xo wu zy".split()}
    text = lambda lang: " ".join(rng.choice(words[lang], 12))
    rows = [(i, text("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb") for i in range(20_000)]
    rows += [(20_000 + i, text("cc"), "cc") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify(docs, F.col("doc_id") < 20_002, sample_rows=200)
    assert {r.doc_id: r.lang_pred for r in got.filter("doc_id >= 20000").collect()} == {20_000 + i: "cc" for i in range(3)}


def test_sample_is_even_bounded_and_takes_the_usual_label(spark):
    rows = [("common text %d here" % (i % 900), "en") for i in range(3000)] + [("rare %d" % i, "xx") for i in range(3)]
    rows += [("twice said", "zz")] * 2 + [("twice said", "en")] + [("a tie", "zz"), ("a tie", "en")]
    table = spark.createDataFrame(rows, "text string, lang string")
    got = sampled(table, sample_rows=90, least=10).collect()
    langs = Counter(r.lang for r in got)
    assert langs["xx"] == 3 and langs["zz"] == 1 and 15 <= langs["en"] <= 38
    small = sampled(table, sample_rows=90, least=10, sample_bytes=3 * 500).collect()
    assert Counter(r.lang for r in small)["en"] >= 1
    assert all(sum(len(r.at) + len(r.tf) for r in small if r.lang == k) <= 500 or n == 1
               for k, n in Counter(r.lang for r in small).items())


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op7_language(spark, sf_dir).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) >= 0.97


def _brute(rows, wanted=None):
    """doc_id -> mean loss difference, from plain counters without the
    document's own tokens."""
    pairs = [lm_scoring.pairs_of(encoder().ids(t).astype("<u2").tobytes()).tolist() for _, t, _ in rows]
    width, weight = lm_scoring.WIDTH, lm_scoring.SMOOTHING
    whole = {True: Counter(), False: Counter()}
    for p, (_, _, is_target) in zip(pairs, rows):
        whole[is_target].update(p)
    known = len({p % width for c in whole.values() for p in c})
    context, token = ({k: Counter() for k in whole} for _ in range(2))
    for k, c in whole.items():
        for p, n in c.items():
            context[k][p // width] += n
            token[k][p % width] += n
    total = {k: sum(c.values()) for k, c in whole.items()}

    def loss(k, p, own):
        uni = (token[k][p % width] - sum(n for q, n in own.items() if q % width == p % width) + 1) / (
            total[k] - sum(own.values()) + known)
        return -math.log((whole[k][p] - own[p] + weight * uni) / (
            context[k][p // width] - sum(n for q, n in own.items() if q // width == p // width) + weight))

    out = []
    for p, (i, _, is_target) in zip(pairs, rows):
        if wanted is not None and i not in wanted:
            out.append((i, None))
            continue
        own = {k: Counter(p) if k == is_target else Counter() for k in whole}
        each = {q: loss(True, q, own[True]) - loss(False, q, own[False]) for q in set(p)}
        out.append((i, sum(each[q] for q in p) / len(p) if p else None))
    return out


@pytest.mark.parametrize("broadcast_pairs", [10 ** 6, 0])
def test_scores_by_array_and_by_join(spark, broadcast_pairs):
    rows = [(1, "good plain words here", True), (2, "good plain words there", True), (3, "odd junk $$ text", False),
            (4, None, False), (5, "", True), (3, "odd junk $$ text", False), (None, "good junk", False), (6, "word " * 3000, False)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, t boolean, pair int")
    got = lm_scoring.score(docs, F.col("t"), broadcast_pairs=broadcast_pairs).collect()
    key = lambda x: (str(x[0]), x[1] is None, x[1] or 0)
    for (a, x), (b, y) in zip(sorted(_brute(rows), key=key), sorted(((r.doc_id, r.score) for r in got), key=key), strict=True):
        assert a == b and (x is None) == (y is None) and abs((x or 0) - (y or 0)) < 1e-9
    assert lm_scoring.score(docs.limit(0), F.col("t"), broadcast_pairs=broadcast_pairs).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    short = {r.doc_id for r in docs if len(r.text or "") < 2500}      # the brute force is quadratic in a text
    rows = [(r.doc_id, r.text, labels.get(r.doc_id) == (1, 0)) for r in docs]
    expected = {i: x for (i, x), r in zip(_brute(rows, short), rows)}
    got = {r.doc_id: r.score for r in op8_lm_scoring(spark, sf_dir).collect()}
    assert set(got) == {r[0] for r in rows} and len(short) > len(rows) / 2
    assert all(abs(got[i] - expected[i]) < 1e-9 for i in short if expected[i] is not None)


def test_a_document_does_not_vouch_for_itself(spark):
    """Two documents with words of their own score alike, whichever side they
    are on; one whose words the others of its side have does not."""
    rows = [(i, "common plain words of all " * 3, i % 2 == 0) for i in range(6)]
    rows += [(10, "zyx wvut zyx wvut", True), (11, "zyx wvut zyx wvut", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
    got = {r.doc_id: r.score for r in lm_scoring.score(docs, F.col("t")).collect()}
    assert got[10] > 0 > got[11]        # each looks like the side that the other one is on


def test_labels_may_repeat(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = lm_scoring.labelled_good(docs, labels).collect()
    assert sorted((r.text, r.is_target) for r in got) == [("a", True), ("b", True), ("c", False), ("d", False)]


def test_query_ranks_good_documents_first(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op8_lm_scoring(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    means = {r.quality: r.m for r in rows.join(labels, "doc_id").groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert means[1] < means[0]
