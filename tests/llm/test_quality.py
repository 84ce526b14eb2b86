import math
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm.queries import op3_quality
from shelfwise.llm.quality import ACCURACY, counts_of, judge, keep_good, quantiles, sketches, text_counts


def _brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = [windows.count(w) > 1 for w in windows]
    covered = {i + k for i, a in enumerate(again) if a for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


def test_counts_against_brute_force():
    rng = random.Random(4)
    alphabet = ["a", "b", "é", "#", " ", " ", "\n", "\t", "\x1c", "\xa0", "\x0b", "漢", "|", "𝄞", "\r"]
    for _ in range(800):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        assert text_counts(text)[:5] == _brute(text), repr(text)
    assert text_counts(None) == text_counts("") == (0,) * 7
    long = "a b c " * 40_000
    assert text_counts(long)[0] == text_counts(long)[4] == 120_000


def _text(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(9)
    rows = [(i, _text(rng, 80), "en", "a") for i in range(60)]
    rows += [(100 + i, " | ".join(_text(rng, 80).split()), "en", "tables") for i in range(60)]   # a source of tables
    rows += [(200, " | ".join(_text(rng, 80).split()), "en", "a"), (201, "too short", "en", "a"), (202, None, None, None),
             (203, "", "en", None), (204, _text(rng, 90), None, "a"), (205, "x y z " * 60, "en", "a"),
             (206, _text(rng, 90), "en", "rare"), (0, rows[0][1], "en", "a")]
    return rows


def test_fences_adapt_to_the_source(documents, mixed, clashes):
    got = judge(documents(mixed, clashes), min_docs=20).collect()
    assert len(got) == len(mixed)
    verdict = {r.doc_id: (r.base_failed, r.failed_ratio, r.kept) for r in got}
    assert all(verdict[i] == (False, None, True) for i in range(60))
    assert all(verdict[100 + i][2] for i in range(60))                    # symbols are normal there
    assert verdict[200] == (False, "symbols_per_word", False)             # but not here
    assert all(verdict[i][0] and not verdict[i][2] for i in (201, 202, 203, 205))
    assert verdict[204][2] and verdict[206][2]


def test_filter_keeps_rows_whole(documents, mixed, clashes):
    docs = documents(mixed, clashes)
    kept = keep_good(docs, min_docs=20)
    assert kept.columns == docs.columns
    by_judge = sorted(r.doc_id for r in judge(docs, min_docs=20).filter("kept").collect())
    assert sorted(r.doc_id for r in kept.collect()) == by_judge
    assert keep_good(docs.limit(0)).count() == 0 and judge(docs.limit(0)).count() == 0


def test_sketches_merge_and_hold_their_error(documents):
    rng = random.Random(6)
    docs = documents([(i, _text(rng, 50 + i), "en", "ab"[i % 2]) for i in range(120)])
    rows = docs.select("lang", "source", counts_of(F.col("text")).alias("c"))
    whole = sketches(rows)
    halves = sketches(rows.filter("source = 'a'")).unionByName(sketches(rows.filter("source = 'b'")))
    levels = {"q1": 0.25, "q3": 0.75}
    read = lambda s: {r.ratio: (r.docs, r.q1, r.q3) for r in quantiles(s, ["ratio"], levels).collect()}
    assert read(whole) == read(halves)
    exact = sorted(r.v for r in rows.select((F.col("c.word_chars") / F.col("c.n_words")).alias("v")).collect())
    docs_seen, q1, q3 = read(whole)["chars_per_word"]
    assert docs_seen == 120
    for q, got in ((0.25, q1), (0.75, q3)):
        assert abs(got - exact[math.ceil(q * 120) - 1]) <= ACCURACY * 1.01 * got


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op3_quality(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        brute = _brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute
        assert r.base_failed == (brute[0] < 50 or 100 * brute[4] > 50 * brute[0])
        assert not (r.kept and r.base_failed)


def test_repeats_that_are_unusual_in_a_source_are_rejected(documents):
    """Well below the base rule's half, in long texts; one repeat in a short text stays."""
    rng = random.Random(12)
    half = lambda n: (lambda words: " ".join(words + [w for _ in range(2) for w in words[:n // 5]]))(_text(rng, n).split())
    rows = [(i, _text(rng, 200), "en", "plain") for i in range(60)]
    rows += [(100 + i, half(200), "en", "refrains") for i in range(60)]
    rows += [(200, half(200), "en", "plain"), (201, (lambda t: f"{t} {' '.join(t.split()[:8])}")(_text(rng, 55)), "en", "plain")]
    got = {r.doc_id: r for r in judge(documents(rows), min_docs=20).collect()}
    assert 0.3 < got[200].n_repeat_words / got[200].n_words < 0.48
    assert got[200].failed_ratio == "repeat_share" and not got[200].base_failed
    assert got[201].kept and got[201].n_repeat_words == 16
    assert all(got[i].kept and got[100 + i].kept for i in range(60))
