import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm.decontamination import GRAM, SPAN, _Grams, _with_words, contamination, drop_contaminated
from shelfwise.llm.queries import op10_decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def _brute(docs, items):
    windows = {}
    for item_id, text in items:
        words = _words(text)
        size = min(SPAN, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + size]), set()).add(str(item_id))
    out = []
    for doc_id, text in docs:
        words, hit, found = _words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(words[i:i + size])]
        out.append((doc_id, len(words), len(hit), tuple(sorted(found)), bool(hit)))
    return out


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(5)
    vocabulary = ["Ab", "b", "C", "été", "ÉTÉ", "x1", "7", "漢", "d", "e"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.randrange(8, 40))) for i in range(12)]
    items += [(100, "only three words"), (101, "one"), (102, ""), (103, None), (104, items[0][1]), (105, "same same same same same same same same same same same")]
    docs = [(i, text(rng.randrange(80))) for i in range(60)]
    for i in range(20):
        _, item = rng.choice(items[:12])
        docs.append((200 + i, text(15) + item[rng.randrange(20):] + text(rng.randrange(15))))
    docs += [(300, None), (301, ""), (302, "...!!!"), (303, "ONE"), (304, "here are only three, WORDS then"), (305, "same " * 3000),
             (306, items[3][1]), (306, items[3][1]), (None, items[4][1])]
    return docs, items, spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, at int")


def _rows(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in frame.collect()), key=str)


def test_against_brute_force(documents, cases, clashes):
    docs, items, bench = cases
    got = _rows(contamination(documents(docs, (*clashes, "f", "at", "len")), bench))
    assert got == sorted(_brute(docs, items), key=str)


def test_filter_and_empty_tables(documents, cases, clashes):
    docs, items, bench = cases
    table = documents(docs, clashes)
    kept = drop_contaminated(table, bench)
    assert kept.columns == table.columns
    clean = [d[0] for d in _brute(docs, items) if not d[4]]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(clean)
    assert contamination(table.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in contamination(table, bench.limit(0)).collect())


def test_minima_are_the_windows_smallest_grams(documents):
    docs = documents([(1, " ".join(f"w{i}" for i in range(40))), (2, "too short"), (3, "a b c d e f g h i j")])
    grams = _Grams(_with_words(docs, "doc_id"))
    minima, hashes = grams.minima(GRAM, SPAN), grams.hashes(GRAM)
    for r in grams.df.select("doc_id", F.col(minima).alias("m"), F.col(hashes).alias("h")).collect():
        width = SPAN - GRAM + 1
        assert r.m == [min(r.h[i:i + width]) for i in range(len(r.h) - width + 1)]


def test_no_python_in_the_plan(documents, cases):
    plan = contamination(documents(cases[0]), cases[2])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan) and "CartesianProduct" not in plan


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    read = lambda t, k: [(r[k], r.text) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").collect()]
    expected = {d[0]: d for d in _brute(read("documents", "doc_id"), read("benchmark", "item_id"))}
    got = op10_decontamination(spark, sf_dir).collect()
    assert len(got) == len(expected)
    for r in got:
        _, n_words, n_hit, items, hit = expected[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n_words, n_hit, len(items), hit)
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()
