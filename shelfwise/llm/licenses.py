"""Licence scans with a generalised suffix automaton.

The words of all licence templates and phrases go into one suffix automaton.  A
text is streamed through it once: after each word the state stands for the
longest run of words, ending there, that occurs in some template (the matching
statistics).  A run that cannot be extended and has at least ``MIN_MATCH`` words
is an anchor, at each place that its state has in a template; anchors that
follow each other in the text and in the template are chained, and a chain that
covers enough of its template is a span.  Phrases are read off the same states:
a phrase ends wherever its state lies on the way to the root.

The automaton has at most two states per word of the templates, which are a
parameter: it grows with them, never with the texts.  Each document is read by
one task, nothing is shuffled."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_workers

#: Least words of an anchor, and most words left out between two of a chain.
MIN_MATCH = 4
MAX_GAP = 30
#: Least share of a template's words that its chain covers.
MIN_COVER = 0.6
#: A template of fewer words is weaker evidence: its score falls in proportion.
FULL_EVIDENCE = 8

# The phrases and labels of the base rule.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# The public wording of common licences and notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
               "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
               "CONDITIONS OF ANY KIND, either express or implied."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
            "(at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
             "License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
             "License, or (at your option) any later version."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("mit", "Released under the MIT License"),
)

_SPAN = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("template", T.IntegerType()),
                                  T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("covered", T.LongType()), T.StructField("share", T.DoubleType())]))
_PLACE = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()),
                                  ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))
_ARROW_PLACE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

#: By byte of a UTF-8 text: A-Z become a-z, digits, letters and all bytes from
#: 0x80 stay, the rest becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased; none for null."""
    return text.translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton of the words of ``templates`` and ``phrases``, both
    (label, text) pairs.  ``places`` has the places (template, end) of every
    state that stands for at least ``min_match`` words."""

    def __init__(self, templates: tuple, phrases: tuple, min_match: int = MIN_MATCH):
        self.labels = [label for label, _ in templates]
        self.vocabulary: dict[bytes, int] = {}
        number = lambda text: [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text.encode())]
        wordings = [number(text) for _, text in templates]
        phrasings = [(label, number(text)) for label, text in phrases]
        self.sizes = [len(w) for w in wordings]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        found: dict[int, list[tuple[int, int]]] = {}
        for template, wording in enumerate(wordings):
            for end, state in enumerate(self._insert(wording), 1):
                found.setdefault(state, []).append((template, end))
        whole: dict[int, list[tuple[str, int]]] = {}
        for label, phrasing in phrasings:
            if phrasing:
                whole.setdefault(self._insert(phrasing)[-1], []).append((label, len(phrasing)))
        by_length = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        places: list[set] = [set(found.get(s, ())) for s in range(len(self.next))]
        for s in reversed(by_length):                 # a state's places are those of all longer ones as well
            if self.length[self.link[s]] >= min_match:
                places[self.link[s]] |= places[s]
        self.places = [sorted(p) for p in places]
        self.ends: list[tuple] = [()] * len(self.next)
        for s in by_length:
            self.ends[s] = self.ends[self.link[s]] + tuple(whole.get(s, ()))

    def _insert(self, wording: list[int]) -> list[int]:
        """Add a sequence; the state of each of its prefixes."""
        last, states = 0, []
        for word in wording:
            last = self._extend(last, word)
            states.append(last)
        # splits may have taken over a prefix's state: read them again
        state, states = 0, []
        for word in wording:
            state = self.next[state][word]
            states.append(state)
        return states

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state({}, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        else:
            self.link[new] = 0
        return new

    def _state(self, following: dict, length: int) -> int:
        self.next.append(following)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: int, state: int) -> int:
        """The part of ``state`` that is as long as the way through ``at``."""
        part = self._state(dict(self.next[state]), self.length[at] + 1)
        self.link[part] = self.link[state]
        self.link[state] = part
        while at >= 0 and self.next[at].get(word) == state:
            self.next[at][word] = part
            at = self.link[at]
        return part

    def stream(self, words: list[bytes], min_match: int = MIN_MATCH) -> tuple[list, list]:
        """Phrases (label, start, end) and anchors (start, end, state) of a
        text, by their ends."""
        phrases, anchors = [], []
        follow, link, length, ends = self.next, self.link, self.length, self.ends
        state = size = 0
        for i, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                if size >= min_match:
                    anchors.append((i - size, i, state))
                state = size = 0
                continue
            if word not in follow[state]:
                if size >= min_match:
                    anchors.append((i - size, i, state))
                while state and word not in follow[state]:
                    state = link[state]
                    size = length[state]
            if word in follow[state]:
                state, size = follow[state][word], size + 1
                if ends[state]:
                    for label, n in ends[state]:
                        if n <= size:
                            phrases.append((label, i + 1 - n, i + 1))
        if size >= min_match:
            anchors.append((len(words) - size, len(words), state))
        return phrases, anchors

    def spans(self, anchors: list, min_cover: float = MIN_COVER, max_gap: int = MAX_GAP) -> list[tuple]:
        """(label, template, start, end, covered, share) of the chains that
        cover enough of their template, by start, end and template."""
        by_template: dict[int, list] = {}
        for start, end, state in anchors:
            for template, at in self.places[state]:
                by_template.setdefault(template, []).append((end, start, at - (end - start), at))
        out = []
        for template, items in by_template.items():
            total = self.sizes[template]
            for start, end, covered in _chains(sorted(items), max_gap):
                if covered >= min_cover * total:
                    out.append((self.labels[template], template, start, end, covered, covered / total))
        return sorted(out, key=lambda s: (s[2], s[3], s[1]))


def _chains(items: list, max_gap: int) -> list[tuple[int, int, int]]:
    """Best chains of one template's anchors (end, start, start and end in the
    template), as (start, end, covered words); no two overlap in the text.  An
    anchor follows one that lies before it on both sides, at most ``max_gap``
    words away on each; of overlapping words only the new ones count."""
    best, before = [], []
    for i, (end, start, t_start, t_end) in enumerate(items):
        value, source = end - start, -1
        for j in range(i - 1, -1, -1):
            e, s, ts, te = items[j]
            if start - e > max_gap:
                break
            if e < end and s < start and ts < t_start and te < t_end and t_start - te <= max_gap:
                gain = best[j] + min(end - start, end - e, t_end - te)
                if gain > value:
                    value, source = gain, j
        best.append(value)
        before.append(source)
    out, taken = [], []
    for i in sorted(range(len(items)), key=lambda i: (-best[i], i)):
        first = i
        while before[first] >= 0:
            first = before[first]
        start, end = items[first][1], items[i][0]
        if all(end <= s or start >= e for s, e in taken):
            taken.append((start, end))
            out.append((start, end, best[i]))
    return out


@lru_cache(maxsize=4)
def _automaton(templates: tuple, phrases: tuple, min_match: int) -> Automaton:
    return Automaton(templates, phrases, min_match)


def license_spans(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES,
                  min_match: int = MIN_MATCH, min_cover: float = MIN_COVER, max_gap: int = MAX_GAP) -> DataFrame:
    """doc_id, n_words, ``phrases`` (label, start, end of every place where a
    phrase's words stand) and ``spans`` (label, template number, start, end,
    covered words, covered share) for every row of ``docs`` (doc_id, text).
    Places are word numbers from 0, ends exclusive; both arrays are by end and
    by start.

    A null or empty text has no words and empty arrays.  Whole texts are read,
    however long.  Repeated rows are reported as often as they stand, a null
    doc_id stays null, an empty table gives no rows, other columns are not
    read.  Of chains that cover equally much the earlier one is taken."""
    python_workers(docs.sparkSession)
    templates, phrases = tuple(map(tuple, templates)), tuple(map(tuple, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(templates, phrases, min_match)
        for batch in batches:
            n_words, places, spans = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                found, anchors = automaton.stream(words, min_match)
                n_words.append(len(words))
                places.append([dict(zip(("label", "start", "end"), p)) for p in found])
                spans.append([dict(zip(("label", "template", "start", "end", "covered", "share"), s))
                              for s in automaton.spans(anchors, min_cover, max_gap)] if anchors else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(places, _ARROW_PLACE), pa.array(spans, _ARROW_SPAN)],
                names=["doc_id", "n_words", "phrases", "spans"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("phrases", _PLACE), T.StructField("spans", _SPAN)])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def verdicts(found: DataFrame, full_evidence: int = FULL_EVIDENCE) -> DataFrame:
    """What ``license_spans`` returned with ``labels`` (distinct, sorted, of
    phrases and spans) and ``score``: the most covered span or phrase, where a
    template or phrase of fewer than ``full_evidence`` words counts in
    proportion; 0 where nothing is found."""
    length = lambda s: s["covered"] / s["share"]
    weight = lambda n: F.least(F.lit(1.0), n / F.lit(float(full_evidence)))
    strength = F.concat(F.transform("spans", lambda s: s["share"] * weight(length(s))),
                        F.transform("phrases", lambda p: weight(p["end"] - p["start"])))
    labels = F.array_sort(F.array_distinct(F.concat("phrases.label", "spans.label")))
    return found.select("*", labels.alias("labels"), F.coalesce(F.array_max(strength), F.lit(0.0)).alias("score"))
