"""Runs of repeated words against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfwise.llm import periodic_runs as P
from shelfwise.llm.queries import op12_periodic_runs


def brute_runs(words, least=6, exponent=4):
    out, n = {}, len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, exponent * p):
                out.setdefault((i, j + p), p)         # periods rise: the smallest stays
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def brute_collapsed(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def test_cover():
    differences = {(a - b) % P.MODULUS for a in P.COVER for b in P.COVER}
    assert differences == set(range(P.MODULUS)) and (P._SYNC >= 0).all()


@pytest.mark.parametrize("seed", range(5))
def test_extensions(seed):
    rng = np.random.default_rng(seed)
    parts = [np.resize(rng.integers(0, 3, rng.integers(1, 60)), rng.integers(1, 400)) for _ in range(6)]
    ids, starts = P._joined([p.astype(np.int32) for p in parts], np.array([len(p) for p in parts]))
    lce = P.Extensions(ids)
    i, j = rng.integers(0, len(ids), (2, 400))
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i.tolist(), j.tolist(), lce(i, j).tolist()):
        n = 0
        while max(a, b) + n < len(ids) and ids[a + n] == ids[b + n]:
            n += 1
        assert got == n


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_many_texts(seed):
    rng = random.Random(seed)

    def text():
        n = rng.choice([0, 1, 5, 6, 7, 30, 80, 200, 400])
        words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n > 6:
                a, p = rng.randrange(n), rng.randrange(1, max(2, n // 4))
                b = min(n, a + p * rng.randrange(3, 9) + rng.randrange(p))
                for i in range(a + p, b):
                    words[i] = words[i - p]
        return words

    texts = [text() for _ in range(25)]
    got = P.find_runs([np.array(t, np.int32) for t in texts])
    for i, words in enumerate(texts):
        assert [tuple(r[1:]) for r in got.tolist() if r[0] == i] == brute_runs(words)


def test_small_chunks_change_nothing(monkeypatch):
    words = np.array(([1, 2, 3] * 40 + [4]) * 5 + [7] * 300, np.int32)
    whole = P.find_runs([words, words[:50], words[::-1].copy()])
    monkeypatch.setattr(P, "CHUNK", 37)
    assert (P.find_runs([words, words[:50], words[::-1].copy()]) == whole).all()


def test_long_repeats_stay_small():
    got = P.find_runs([np.zeros(300_000, np.int32)])
    assert got.tolist() == [[0, 0, 300_000, 1]]


def test_edges(documents, clashes):
    line = "same old line again and"
    long = "é w " * 40_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a b"), (6, f"x {line} " + f"{line}\n" * 5),
            (7, long), (7, long), (None, "a a a a a a a a a a a a")]
    got = P.periodic_runs(documents(rows, clashes)).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", next(t for i, t in rows if i == r.doc_id) or "")
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == brute_runs(words)
        assert r.n_words == len(words)
        assert r.collapsed == " ".join(brute_collapsed(words, [tuple(x) for x in r.runs]))
    assert [tuple(x) for x in next(r for r in got if r.doc_id == 7).runs] == [(0, 80_000, 2)]
    assert P.periodic_runs(documents([])).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    periodic = 0
    for r in op12_periodic_runs(spark, sf_dir).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        periodic += bool(runs)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.runs_sha256 == digest("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert r.collapsed_sha256 == digest(" ".join(brute_collapsed(words, runs)))
    assert periodic
