"""Licence scans: the automaton against plain searches."""

import random
import re

import pytest

from shelfwise.llm import licenses as L
from shelfwise.llm.queries import op11_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _phrase_places(text):
    words, out = _words(text), []
    for label, phrase in L.PHRASES:
        parts = phrase.split()
        out += [(label, i, i + len(parts)) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    return sorted(out, key=lambda p: (p[1], p[0]))


def _longest(words, templates):
    """Brute force: for every end, the longest stretch that some template has."""
    have = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [next((n for n in range(i, 0, -1) if tuple(words[i - n:i]) in have), 0) for i in range(1, len(words) + 1)]


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics_and_places(seed):
    rng = random.Random(seed)
    letters = "abc"[:2 + seed % 2]
    text = lambda n: [rng.choice(letters) for _ in range(n)]
    templates = [text(rng.randint(1, 14)) for _ in range(4)]
    automaton = L.Automaton(tuple((str(i), " ".join(t)) for i, t in enumerate(templates)), (("p", "a b"),), min_match=2)
    words = text(60)
    phrases, anchors = automaton.stream([w.encode() for w in words], min_match=2)
    assert [p[1] for p in phrases] == [i for i in range(59) if words[i:i + 2] == ["a", "b"]]
    longest = _longest(words, templates + [["a", "b"]])
    expected = [(i - n, i) for i, n in enumerate(longest, 1)
                if n >= 2 and (i == len(words) or longest[i] != n + 1)]
    assert [(s, e) for s, e, _ in anchors] == expected
    for start, end, state in anchors:
        part = words[start:end]
        assert automaton.places[state] == [(t, j) for t, w in enumerate(templates) for j in range(len(part), len(w) + 1)
                                           if w[j - len(part):j] == part]


def _mangled(rng, template, drop):
    return " ".join(w for w in template.split() if rng.random() >= drop)


def test_spans_of_whole_and_changed_templates(spark, documents):
    rng = random.Random(4)
    filler = " ".join(rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(40))
    rows = [(i, f"{filler} {text} {filler}") for i, (_, text) in enumerate(L.TEMPLATES)]
    rows += [(100 + i, f"{filler} {_mangled(rng, text, 0.04)} {filler}") for i, (_, text) in enumerate(L.TEMPLATES[:4])]
    rows += [(200, filler), (201, f"{L.TEMPLATES[0][1]} {L.TEMPLATES[2][1]} {L.TEMPLATES[0][1]}"),
             (202, " ".join(L.TEMPLATES[0][1].split()[:20]))]
    got = {r.doc_id: r for r in L.license_spans(documents(rows)).collect()}
    for i, (label, text) in enumerate(L.TEMPLATES):
        n = len(_words(text))
        whole = [s for s in got[i].spans if s.template == i]
        assert [(s.label, s.start, s.end, s.covered, s.share) for s in whole] == [(label, 40, 40 + n, n, 1.0)]
    for i in range(4):
        assert any(s.template == i and s.share > 0.6 and s.start <= 44 for s in got[100 + i].spans)
    assert got[200].spans == [] and got[200].phrases == []
    assert [s.label for s in got[201].spans if s.template in (0, 2)] == ["mit", "bsd", "mit"]
    assert not [s for s in got[202].spans if s.template == 0]
    scores = {r.doc_id: r.score for r in L.verdicts(L.license_spans(documents(rows))).collect()}
    assert scores[0] == 1.0 and scores[200] == 0.0 and all(0 <= s <= 1 for s in scores.values())


def test_edges(spark, documents, clashes):
    long = "x " * 60_000 + "GNU General Public-License " + "mit License " * 3
    rows = [(1, None), (2, ""), (3, "!?"), (4, long), (4, long), (None, "CC by"), (6, "gnu general public license"),
            (7, "MIT\nLICENSE apache licenses Äpache license")]
    got = L.license_spans(documents(rows, clashes)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert [tuple(p) for p in sorted(r.phrases, key=lambda p: (p.start, p.label))] == _phrase_places(
            next(t for i, t in rows if i == r.doc_id))
    assert [r.n_words for r in by[1] + by[2] + by[3]] == [0, 0, 0]
    assert len(by[4]) == 2 and by[4][0].n_words == 60_010 and len(by[4][0].phrases) == 4
    assert by[None][0].phrases[0].label == "cc-by"
    assert L.license_spans(documents([]), ()).count() == 0


def test_query_against_plain_search(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen = 0
    for r in op11_licenses(spark, sf_dir).collect():
        places = _phrase_places(texts[r.doc_id])
        starts = [p[1] for p in places]
        assert (r.n_words, r.n_base) == (len(_words(texts[r.doc_id])), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        base = sorted({p[0] for p in places})
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
        seen += len(places)
    assert seen
