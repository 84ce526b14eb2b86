"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from shelfwise.llm import spelling as S
from shelfwise.llm.queries import op13_spelling


def _deletions(word):
    return {word[:i] + word[i + 1:] for i in range(len(word))}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and short in _deletions(long)


def brute(counts):
    """Candidates by a shared deletion, decided by the definition."""
    by = {}
    for w in counts:
        for d in {w} | _deletions(w):
            by.setdefault(d, set()).add(w)
    near = {w: set() for w in counts}
    for w in counts:
        for d in {w} | _deletions(w):
            near[w] |= {u for u in by[d] if u != w and _near(u, w)}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda u: (-counts[u], u), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            forms[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, n, len(near[w]), counts[forms[w]] if w in forms else None))
    return sorted(rows)


def _got(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


@pytest.mark.parametrize("letters,sizes,limits", [
    ("ab", (1, 7), {}), ("abc", (2, 6), {"small_bytes": 0}), ("abcdé", (3, 8), {"small_bytes": 0, "hot_words": 5})])
def test_all_pairs_of_a_dense_vocabulary(spark, letters, sizes, limits):
    """Short words over few letters are near in every way; also with tables
    that are shuffled and with nodes joined apart."""
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(150)}
    counts = {w: rng.choice([1, 2, 3, 4, 8, 8, 16, 40, 100]) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _got(S.variants(table, **limits)) == brute(counts)


def test_each_pair_once(spark):
    words = ["aaaaa", "aaaaaa", "aaaa", "abaaa", "aabaa", "aaaab", "baaaa"]
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    pairs = [tuple(sorted((r.word, r.near))) for r in S.neighbours(table).collect()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if a < b and _near(a, b))


def test_very_long_words(spark):
    """Levels follow the nodes, not the letters."""
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh") for _ in range(40_000))
    counts = {long: 9, long[:25_000] + long[25_001:]: 4, long[:10] + "z" + long[11:]: 2, long[:-1]: 1, long[5:]: 7, "short": 3}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _got(S.variants(table)) == brute(counts)


def test_chains_and_ties(spark):
    """Forms are followed to the last one; equal counts take the smaller word."""
    counts = {"w" + "a" * i + "b" * (8 - i): 2 ** i for i in range(9)} | {"tiexx": 4, "tieya": 8, "tieyx": 8, "tiezx": 8}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _got(S.variants(table)) == brute(counts)


def test_edges(spark, documents, clashes):
    nothing = documents([], clashes)
    assert S.word_counts(nothing).count() == 0
    assert S.variants(S.word_counts(nothing)).count() == 0
    odd = spark.createDataFrame([(None, 3, 1), ("", 3, 1), ("alpha", None, 1), ("alphas", 2, 1)], "word string, n long, side int")
    assert _got(S.variants(odd)) == [("alphas", None, "alphas", 2, 0, None)]
    text = "ÉCOLE école don't x×y÷zwv letter-LETTER " + "verylongword" * 3000
    rows = [(1, text), (1, text), (1, text), (None, "Letter Ćabcde 😀fghij".encode("utf-16", "surrogatepass").decode("utf-16")),
            (3, None), (4, "")]
    expected = Counter()
    for _, t in rows:
        expected.update(re.findall("[A-Za-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    got = {r.word: r.n for r in S.word_counts(documents(rows, clashes)).collect()}
    assert got == {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    assert "École" in got and "x×y÷zwv" in got and got["letter"] == 7


def test_counts_are_passed_on_in_parts(documents, monkeypatch):
    monkeypatch.setattr(S, "HELD_WORDS", 2)
    rows = [(i, "first second third fourth fifth sixth") for i in range(5)]
    assert {(r.word, r.n) for r in S.word_counts(documents(rows)).collect()} == {
        (w, 5) for w in "first second third fourth fifth sixth".split()}


def test_query_against_brute_force(spark, sf_dir):
    counts = Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    expected = brute({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    got = _got(op13_spelling(spark, sf_dir))
    assert got == expected and any(r[1] for r in got)
