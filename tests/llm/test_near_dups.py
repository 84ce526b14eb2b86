import random

import numpy as np
import pytest

from shelfwise.llm.alignment import within
from shelfwise.llm.components import components
from shelfwise.llm import near_dups
from shelfwise.llm.near_dups import SKETCHES, candidate_keys, near_duplicates, one_of_each
from shelfwise.llm.queries import op2_near_dups

WORDS = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ar", "en", "ist", "ol", "um")]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_against_edit_distance():
    rng = random.Random(3)
    for _ in range(600):
        a = [rng.randrange(rng.choice((2, 30))) for _ in range(rng.randrange(25))]
        b = [x for x in a if rng.random() > 0.1] + [rng.randrange(5) for _ in range(rng.randrange(4))]
        d = _distance(a, b)
        for limit in {0, max(d - 1, 0), d, d + 2}:
            assert within(a, b, limit) == (d <= limit)


@pytest.mark.parametrize("n", [30_000, 40_000])
def test_long_runs_align(n):
    """On both sides of the length from which the band's places are kept apart."""
    a = list(range(n))
    b = [x for x in a if x not in (5, 9_000, 29_000)]
    b[100] = -1
    assert within(a, b, 4) and not within(a, b, 3)


def test_band_at_every_limit():
    """The bit-vector band and the furthest positions agree with the distance."""
    from shelfwise.llm import alignment
    rng = random.Random(9)
    for _ in range(300):
        a = [rng.randrange(rng.choice((2, 3, 30))) for _ in range(rng.randrange(2, 60))]
        b = [rng.randrange(3) if rng.random() < 0.2 else x for x in a if rng.random() > 0.1] or [1]
        a, b = sorted((a, b), key=len, reverse=True)
        d = _distance(a, b)
        for limit in range(len(a) - len(b), len(a)):
            assert alignment._band(a, b, limit) == (d <= limit)
            assert alignment._reaches(np.array(a), np.array(b), limit) == (d <= limit)


def test_sketches_follow_order_and_ignore_batches():
    text = " ".join(random.Random(1).choices(WORDS, k=60))
    alone = candidate_keys([text])[0]
    assert len(alone) == SKETCHES
    assert candidate_keys(["other text here", text, None, ""])[1] == alone
    assert candidate_keys([None, "", "   "]) == [[], [], []]
    half = text.split()
    moved = " ".join(half[30:] + half[:30])
    assert len(set(alone) & set(candidate_keys([moved])[0])) < SKETCHES
    assert len(candidate_keys(["a b"])[0]) == SKETCHES     # fewer words than a k-mer: all of them as one
    assert candidate_keys(["a b"]) != candidate_keys(["b a"])


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    root = {n: n for link in links for n in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    base = [rng.choices(WORDS, k=80) for _ in range(6)]
    edited = lambda words, n: [rng.choice(WORDS) if i in set(rng.sample(range(len(words)), n)) else w for i, w in enumerate(words)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    rows += [(10, " ".join(base[0])), (11, " ".join(edited(base[0], 4))), (12, " ".join(edited(base[0], 4))),
             (13, " ".join(base[1][40:] + base[1][:40])),     # same words, other order
             (14, " ".join(edited(base[2], 50))), (15, None), (16, None), (17, ""), (18, ""), (19, "!!! ???"),
             (20, "two words"), (20, "two words"), (None, "no id here at all, but enough words"),
             (21, " ".join(base[3] * 300)), (22, " ".join(base[3] * 300) + " end")]
    return rows


def test_classes(documents, corpus, clashes):
    got = near_duplicates(documents(corpus, clashes)).collect()
    assert len(got) == len(corpus)
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    groups = sorted(sorted(v) for k, v in classes.items() if len(v) > 1)
    assert groups == [[0, 10, 11, 12], [17, 18], [20, 20], [21, 22]]
    assert {r.doc_id: r.text_copies for r in got}[10] == 2


def test_one_of_each_keeps_rows_whole(documents, corpus, clashes):
    docs = documents(corpus, clashes)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([0, 1, 2, 3, 4, 5, 13, 14, 15, 16, 17, 19, 20, None, 21], key=str)
    assert one_of_each(docs.limit(0)).count() == 0 and near_duplicates(docs.limit(0)).count() == 0


def test_large_group_without_pairs(documents):
    """A group of near copies and one of exact copies."""
    rng = random.Random(2)
    base = rng.choices(WORDS, k=70)
    rows = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(70)] = f"odd{i}"
        rows.append((i, " ".join(words)))
    rows += [(500, "one two three four five six"), (501, "one two three four five seven")]
    rows += [(1000 + i, "the very same text in every row of this group") for i in range(100)]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(rows)).collect()}
    assert got[500] == got[501] == 500 and {got[i] for i in range(150)} == {0} and {got[1000 + i] for i in range(100)} == {1000}


def test_query_finds_every_similar_pair(spark):
    from shelfwise.llm.near_dups import similar
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in op2_near_dups(spark, sf_dir).collect()}
    ids = sorted(docs)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if find(i) != find(j) and similar(docs[i], docs[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in ids}


def _meeting(rng, words, share, pairs=150):
    """Share of pairs that have a key in common: of texts with up to ``words``
    words, one has scattered other words in place of 1 - ``share`` of them."""
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(pairs):
        a = rng.choices(vocabulary, k=words)
        odd = rng.sample(range(words), int((1 - share) * words + 1e-9))
        texts += [" ".join(a), " ".join(f"x{rng.getrandbits(40)}" if i in set(odd) else w for i, w in enumerate(a))]
    keys = [set(k) for k in candidate_keys(texts)]
    return sum(bool(a & b) for a, b in zip(keys[::2], keys[1::2])) / pairs


@pytest.mark.parametrize("words", [64, 200, 600])
def test_recall_by_similarity_of_long_texts(words):
    rng = random.Random(31)
    assert all(_meeting(rng, words, share) >= least for share, least in
               ((0.8, 0.97), (0.825, 0.98), (0.85, 0.99), (0.875, 0.99), (0.9, 1.0), (0.95, 1.0)))


def test_pairs_on_both_sides_of_the_short_length_meet():
    from shelfwise.llm.near_dups import similar
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(200):
        a = rng.choices(vocabulary, k=66)
        b = [f"x{rng.getrandbits(40)}" if i in (7, 15, 23, 31, 39, 47, 55) else w for i, w in enumerate(a)]
        for at in sorted(rng.sample(range(66), 6), reverse=True):
            del b[at]
        texts += [" ".join(a), " ".join(b)]
        assert len(b) == 60 < 64 < len(a) and similar(*texts[-2:])
    keys = [set(k) for k in candidate_keys(texts)]
    assert sum(bool(a & b) for a, b in zip(keys[::2], keys[1::2])) >= 195


def test_copies_meet_behind_an_unlike_leader(documents):
    """Texts that share a passage: pairs of them are near copies, though their
    own parts differ and most groups have an unlike smallest text."""
    rng = random.Random(23)
    own = lambda n: [f"o{rng.getrandbits(40)}" for _ in range(n)]
    passage, rows = own(150), []
    for i in range(25):
        part = own(50)
        changed = list(part)
        for at in rng.sample(range(50), 38):
            changed[at] = own(1)[0]
        rows += [(2 * i, " ".join(passage + part)), (2 * i + 1, " ".join(passage + changed))]
    rows += [(100 + i, " ".join(passage + own(50))) for i in range(150)]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(rows)).collect()}
    assert got == {i: i - i % 2 if i < 50 else i for i, _ in rows}


@pytest.mark.parametrize("band", [(0.80, 0.85), (0.85, 0.90), (0.90, 1.0)])
def test_recall_of_edited_texts_by_band(band):
    """Texts of 40 to 400 words of a natural vocabulary with scattered
    replaced, deleted and inserted words, by their measured similarity."""
    rng = random.Random(37)
    weights = [1 / (i + 3) for i in range(4000)]
    vocabulary = [f"w{i}" for i in range(4000)]
    pairs = []
    while len(pairs) < 300:
        a = rng.choices(vocabulary, weights, k=rng.randint(40, 400))
        rate, b = rng.uniform(0.02, 0.22), []
        for w in a:
            x = rng.random()
            b += [w] if x > rate else [[rng.choice(vocabulary)], [], [w, rng.choice(vocabulary)]][rng.randrange(3)]
        limit = lambda share: int((1 - share) * max(len(a), len(b)) + 1e-9)
        if within(a, b, limit(band[0])) and not (band[1] < 1 and within(a, b, limit(band[1]))):
            pairs += [" ".join(a), " ".join(b)]
    keys = [set(k) for k in candidate_keys(pairs)]
    assert sum(bool(x & y) for x, y in zip(keys[::2], keys[1::2])) >= 0.95 * len(keys) / 2


def test_two_components_of_a_large_group_are_all_compared(documents, monkeypatch):
    """Chains: the leader is alike to one text only, which is alike to the next;
    small blocks, so that bands and blocks meet in every way."""
    monkeypatch.setattr(near_dups, "BLOCK", 3)
    monkeypatch.setattr(near_dups, "ROUNDS", 1)
    rng = random.Random(41)
    fresh = lambda n: [f"o{rng.getrandbits(40)}" for _ in range(n)]
    rows, text = [], fresh(100)
    for i in range(24):                                   # each differs from the one before in 18 words, at moving places
        rows.append((i, " ".join(text)))
        text = list(text)
        for at in range(18):
            text[(i * 18 + at) % 100] = fresh(1)[0]
        if i % 3 == 0:
            text = text + fresh(2)
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(rows)).collect()}
    assert set(got.values()) == {0}


def test_large_links_are_shuffled(spark, monkeypatch):
    from shelfwise.llm import components as module
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 7] + [(0, 100), (100, 3)], "u long, v long")
    expected = sorted(map(tuple, components(links).collect()))
    monkeypatch.setattr(module, "FEW_LINKS", 0)
    assert sorted(map(tuple, components(links).collect())) == expected


@pytest.mark.parametrize("wide", [False, True])
def test_profiles_drop_no_pair_that_aligns(wide):
    from shelfwise.llm.near_dups import WIDE, _profile_bytes, _word_hashes, may_align, profile, similar
    rng = random.Random(29)
    texts = []
    for n in (3, 10, 40, 200, 900):
        base = rng.choices(WORDS, k=n)
        texts += [" ".join(w for w in base if rng.random() > cut) for cut in (0, 0.1, 0.2, 0.3) for _ in range(4)]
    texts += ["again " * 900, "again " * 800 + "other " * 60]           # more than a bucket's byte counts
    shown = _profile_bytes(*_word_hashes(texts), WIDE) if wide else [profile(t) for t in texts]
    found = {(i, j) for at, j in may_align(shown, shown, np.zeros(len(texts)), np.ones(len(texts))) for i in at.tolist()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (i, j) in found or not similar(a, b)
    assert len(found) < len(texts) ** 2


def test_profiles_use_exact_numbers_of_words():
    """A word more often than a bucket counts: what one side lacks follows from
    the other side and the lengths."""
    from shelfwise.llm.near_dups import WIDE, _profile_bytes, _word_hashes, may_align, similar
    texts = ["again " * 700 + " ".join(f"a{i}" for i in range(50)), "again " * 570 + " ".join(f"b{i}" for i in range(130))]
    assert not similar(*texts)                            # 180 of 750 words differ
    for size in (near_dups.BUCKETS, WIDE):
        a, b = _profile_bytes(*_word_hashes(texts), size)
        assert may_align([a], [b], np.zeros(1), np.ones(1)) == may_align([b], [a], np.zeros(1), np.ones(1)) == []


def test_near_copies_of_an_open_group_are_not_all_aligned(spark, documents, monkeypatch):
    """Near copies that share no sketch but those of a passage that many unlike
    texts have: after each one's likeliest pairs they are one component."""
    monkeypatch.setattr(near_dups, "ROUNDS", 0)
    aligned, compare = spark.sparkContext.accumulator(0), near_dups._similar

    def counted(x, y, similarity):
        aligned.add(1)
        return compare(x, y, similarity)

    monkeypatch.setattr(near_dups, "_similar", counted)
    rng = random.Random(43)
    own = lambda n: [f"o{rng.getrandbits(40)}" for _ in range(n)]
    passage, common = own(150), own(50)
    rows = [(i, " ".join(passage + [w if at % 3 == 0 else own(1)[0] for at, w in enumerate(common)])) for i in range(50)]
    rows += [(100 + i, " ".join(passage + own(50))) for i in range(100)]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(rows)).collect()}
    assert got == {i: 0 if i < 50 else i for i, _ in rows}
    assert 49 <= aligned.value < 400                      # of 1225 pairs that align


def test_texts_of_several_groups_meet_in_one():
    from shelfwise.llm.near_dups import shared_keys
    rng = random.Random(47)
    a, b = ([np.array(sorted(rng.sample(range(-30, 30), rng.randrange(1, 12)))) for _ in range(40)] for _ in range(2))
    met = np.zeros((40, 40), int)
    for key in range(-30, 30):
        here = [[i for i, x in enumerate(side) if key in x] for side in (a, b)]
        if all(here):
            shared, meet = shared_keys([a[i] for i in here[0]], [b[j] for j in here[1]], key)
            met[np.ix_(*here)] += meet
            assert shared.tolist() == [[len(set(a[i]) & set(b[j])) for j in here[1]] for i in here[0]]
    assert met.tolist() == [[int(bool(set(x) & set(y))) for y in b] for x in a]
