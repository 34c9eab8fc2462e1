"""Licence scans: a generalised suffix automaton over the words of licence templates, streamed over whole texts.

One automaton holds every run of words of every template. A text is streamed through it word by word; at each word it tells
the longest run ending there that some template holds (the matching statistics). A run that the next word does not prolong
is a match, credited to all places of templates that hold it. Matches of at least ``LONG`` words are chained for each template:
in a series of matches with no gap above ``GAP`` words, the chain that goes forward in text and template and covers most of the
template's words is a span. A span that covers at least ``COVERED`` of its template gives the template's label. Phrases are
short templates that count wherever they stand whole.

A text is one row and its work is linear in its words; nothing is shuffled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.llm.common import ship, small_batches

LONG, GAP, COVERED = 4, 24, 0.75
#: Bytes of a text that are split into words at once.
STEP = 1 << 20
#: A-Z to a-z, and all but ASCII letters, digits and bytes of other characters to spaces.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: Phrases that count wherever they stand, and their labels.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

#: The words of public licence notices, and their labels.
TEMPLATES = [
    ("cc-by-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("public-domain", "This work is dedicated to the public domain under CC0 1.0 Universal"),
]


def words_of(text: bytes, step: int = STEP) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, some at a time: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    at = 0
    while at < len(text):
        end = at + step
        while end < len(text) and TABLE[text[end]] != 32:
            end += 1
        yield text[at:end].translate(TABLE).split()
        at = end


class Automaton:
    """The suffix automaton of several sequences of numbers, with the places where each state's runs end."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # of each state: (sequence, number of its items up to the end)
        for number, sequence in enumerate(sequences):
            last = 0
            for at, item in enumerate(sequence):
                last = self._extend(last, item)
                self.ends[last].append((number, at + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, state: int, item: int) -> int:
        """The state of ``state``'s longest run with ``item`` behind it, made if longer runs share it now."""
        to = self.next[state][item]
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._state(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while state >= 0 and self.next[state].get(item) == to:
            self.next[state][item] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, item: int) -> int:
        if item in self.next[last]:
            return self._split(last, item)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and item not in self.next[state]:
            self.next[state][item] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, item)
        return new


class Scanner:
    """Licence spans and phrases of texts."""

    def __init__(self, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, long: int = LONG, gap: int = GAP, covered: float = COVERED) -> None:
        self.long, self.gap, self.covered = long, gap, covered
        self.labels, self.n_phrases = [label for label, _ in [*phrases, *templates]], len(phrases)
        split = [[w for part in words_of(text.encode()) for w in part] for _, text in [*phrases, *templates]]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for words in split for w in words))}
        self.sizes = [len(words) for words in split]
        self.automaton = Automaton([[self.vocabulary[w] for w in words] for words in split])
        # a phrase ends where the run's state, or one it links to, ends it whole: a run holds all shorter runs of its links
        self.whole = [[t for t, n in set(ends) if t < self.n_phrases and n == self.sizes[t] and n <= self.automaton.length[s]] for s, ends in enumerate(self.automaton.ends)]
        for state in sorted(range(1, len(self.whole)), key=lambda s: self.automaton.length[s]):
            if self.automaton.link[state] > 0:
                self.whole[state] = sorted({*self.whole[state], *self.whole[self.automaton.link[state]]})

    def runs(self, parts: Iterator[list[bytes]]) -> Iterator[tuple[int, int, int, bool]]:
        """(end, length, state, kept on) for each word of the vocabulary; the last tells whether the word prolonged the run before it.

        The number of words is the end of the last row, whose length is 0.
        """
        arcs, link, longest, known = self.automaton.next, self.automaton.link, self.automaton.length, self.vocabulary.get
        state = length = at = 0
        previous = -1
        for words in parts:
            for here, item in enumerate(map(known, words), at):
                if item is None:
                    continue
                if here != previous + 1:
                    state = length = 0
                grown = length
                while state and item not in arcs[state]:
                    state = link[state]
                    length = longest[state]
                if item in arcs[state]:
                    state = arcs[state][item]
                    length += 1
                yield here + 1, length, state, length == grown + 1 and grown > 0
                previous = here
            at += len(words)
        yield at, 0, 0, False

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]], list[int]]:
        """(words, phrase places as (start, phrase), spans as (template, start, end, covered words), most words covered of each template)."""
        places: list[tuple[int, int]] = []
        spans: list[tuple[int, int, int, int]] = []
        most = [0] * len(self.sizes)
        # of each template's open series: its matches within the gap, where it ends, its best chain as (covered, -start, end)
        series: dict[int, tuple[deque, int, tuple[int, int, int]]] = {}

        def close(template: int) -> None:
            covered, start, end = series.pop(template)[2]
            most[template] = max(most[template], covered)
            if covered >= self.covered * self.sizes[template]:
                spans.append((template, -start, end, covered))

        def matched(end: int, length: int, state: int) -> None:
            start = end - length
            for template, stop in self.automaton.ends[state]:
                if template < self.n_phrases:
                    continue
                if template in series and start - series[template][1] > self.gap:
                    close(template)
                near, _, best = series.get(template, (deque(), 0, (0, 0, 0)))
                while near and start - near[0][1] > self.gap:
                    near.popleft()
                covered, first = length, start
                for s, e, z, c, f in near:
                    # forward in text and template; what both matches cover counts once
                    lap = max(0, e - start, z - (stop - length))
                    if s < start and e < end and z < stop and lap < length and c + length - lap > covered:
                        covered, first = c + length - lap, f
                near.append((start, end, stop, covered, first))
                series[template] = (near, end, max(best, (covered, -first, end)))

        held = (0, 0, 0)
        total = 0
        for end, length, state, on in self.runs(words_of(text or b"")):
            if held[1] >= self.long and not (on and length == held[1] + 1):
                matched(*held)
            held = (end, length, state)
            for phrase in self.whole[state]:
                # of the state's own runs the shorter ones may be too short to hold the phrase
                if length >= self.sizes[phrase]:
                    places.append((end - self.sizes[phrase], phrase))
                    most[phrase] = self.sizes[phrase]
            total = end
        for template in sorted(series):
            close(template)
        return total, places, sorted(spans, key=lambda s: (s[1], s[2], s[0])), most


def scan(docs: DataFrame, scanner: Scanner | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``phrases`` (array of start and label), ``spans`` (array of label, start, end, covered, share) and ``best_share``.

    Starts and ends count words from 0, the end being the word behind. ``best_share`` is the largest part of any template or phrase
    that a chain of the text covers, 0 without one. A null or empty text has no words and nothing else. Repeated rows are
    scanned each; columns of ``docs`` with these names are replaced, all others are kept. Of chains that cover as much, the
    earliest counts; of labels at one place each is told.
    """
    scanner = scanner or Scanner()
    small_batches(docs.sparkSession)
    kind = "struct<n_words:long,phrases:array<struct<start:long,label:string>>,spans:array<struct<label:string,start:long,end:long,covered:long,share:double>>,best_share:double>"
    arrow = pa.struct(
        [
            ("n_words", pa.int64()),
            ("phrases", pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
            ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))),
            ("best_share", pa.float64()),
        ]
    )

    @F.arrow_udf(kind)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labels, sizes = scanner.labels, scanner.sizes
        for batch in batches:
            out = []
            for data in batch.cast(pa.binary()):
                words, places, spans, most = scanner.scan(data.as_py())
                out.append(
                    {
                        "n_words": words,
                        "phrases": [{"start": s, "label": labels[p]} for s, p in places],
                        "spans": [{"label": labels[t], "start": s, "end": e, "covered": c, "share": c / sizes[t]} for t, s, e, c in spans],
                        "best_share": max((m / n for m, n in zip(most, sizes, strict=True)), default=0.0),
                    }
                )
            yield pa.array(out, arrow)

    names = ["n_words", "phrases", "spans", "best_share"]
    kept = [c for c in docs.columns if c not in names]
    mark = "_found" if "_found" not in kept else "_found_" + "_".join(kept)
    return docs.select(*kept, found(F.col(text).cast("string")).alias(mark)).select(*kept, *[F.col(mark)[n].alias(n) for n in names])


ship(__name__)
