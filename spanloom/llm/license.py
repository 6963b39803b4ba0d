"""Licence texts in documents: matching statistics on a generalised suffix automaton, chained into covered spans."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.words import parts

#: Phrases that name a licence wherever their words stand in a row. Fixed values.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Opening words, notices and grants of public licences: (label, text). Fixed values.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)

#: Words of all templates and phrases together: the automaton, of at most twice as many states, is broadcast.
MOST_WORDS = 2_000_000
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

#: A-Z in lower case; what is no letter, digit or character beyond ASCII becomes a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def pieces_of(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in runs of `size` bytes and the rest of the last word."""
    at = 0
    while at < len(text):
        cut = _SEPARATOR.search(text, at + size)
        end = cut.end() if cut else len(text)
        yield words_of(text[at:end])
        at = end


@dataclass
class Automaton:
    """A suffix automaton of several sequences of word numbers.

    step[s] leads on from state s, link[s] is the state of the longest suffix in another class, longest[s] the length of
    a state's longest string. places[s] has (template, end) of each place where the state's strings stand: what a
    match of s may be aligned with. phrases[s] has the phrases that end wherever s is reached with at least their length."""

    labels: list[str]
    sizes: list[int]
    words: dict[bytes, int]
    step: list[dict[int, int]]
    link: list[int]
    longest: list[int]
    places: list[tuple[tuple[int, int], ...]]
    phrases: list[tuple[tuple[int, int], ...]]
    phrase_labels: list[str]
    phrase_sizes: list[int]


def _extend(a: Automaton, last: int, w: int) -> int:
    """The state of `last` followed by w, made if it isn't there yet; the other sequences' states stay right."""
    step, link, longest = a.step, a.link, a.longest

    def split(p: int, q: int) -> int:
        step.append(dict(step[q]))
        link.append(link[q])
        longest.append(longest[p] + 1)
        clone = len(step) - 1
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = clone
            p = link[p]
        link[q] = clone
        return clone

    if w in step[last]:
        q = step[last][w]
        return q if longest[q] == longest[last] + 1 else split(last, q)
    step.append({})
    link.append(-1)
    longest.append(longest[last] + 1)
    new, p = len(step) - 1, last
    while p >= 0 and w not in step[p]:
        step[p][w] = new
        p = link[p]
    if p < 0:
        link[new] = 0
    else:
        q = step[p][w]
        link[new] = q if longest[q] == longest[p] + 1 else split(p, q)
    return new


def build(templates=TEMPLATES, phrases=PHRASES, least: int = 4) -> Automaton:
    """The automaton of all templates and phrases, (label, text) and (text, label). Places are kept for states whose
    longest string has at least `least` words; templates without words are left out."""
    found = [(label, words_of(text.encode())) for label, text in templates]
    found = [(label, w) for label, w in found if w]
    named = [(label, words_of(text.encode())) for text, label in phrases]
    named = [(label, w) for label, w in named if w]
    if sum(len(w) for _, w in found + named) > MOST_WORDS:
        raise ValueError(f"templates have over {MOST_WORDS} words together")
    a = Automaton([x for x, _ in found], [len(w) for _, w in found], {}, [{}], [-1], [0], [], [], [x for x, _ in named], [len(w) for _, w in named])
    for _, w in found + named:
        state = 0
        for x in w:
            state = _extend(a, state, a.words.setdefault(x, len(a.words)))
    # where a prefix ends, its state's strings end; all of a state's places are also its link's
    own: list[list[tuple[int, int]]] = [[] for _ in a.step]
    for number, (_, w) in enumerate(found):
        state = 0
        for i, x in enumerate(w):
            state = a.step[state][a.words[x]]
            own[state].append((number, i + 1))
    order = sorted(range(len(a.step)), key=lambda s: -a.longest[s])
    for s in order:
        if a.link[s] > 0 and a.longest[a.link[s]] >= least:
            own[a.link[s]].extend(own[s])
    a.places = [tuple(sorted(set(x))) if a.longest[s] >= least else () for s, x in enumerate(own)]
    ending: list[list[tuple[int, int]]] = [[] for _ in a.step]
    for k, (_, w) in enumerate(named):
        state = 0
        for x in w:
            state = a.step[state][a.words[x]]
        ending[state].append((k, len(w)))
    for s in reversed(order):
        if a.link[s] > 0:
            ending[s] = ending[a.link[s]] + ending[s]
    a.phrases = [tuple(x) for x in ending]
    return a


_PLACE = [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
_TYPES = (pa.int64(), pa.list_(pa.struct(_PLACE)), pa.list_(pa.struct([*_PLACE, ("covered", pa.int64()), ("size", pa.int64())])), pa.float64())


class Chains:
    """Matches with each template joined into chains as they come, in the order of their ends in the text.

    A match goes on from the chain of its template that gains most: one that ends before it in the text and in the
    template, less than `gap` words back in either; of words that both have, the overlap is taken off. Chains that end further back
    are closed, so that only those of the last `gap` words are held."""

    def __init__(self, gap: int):
        self.gap, self.open, self.done = gap, {}, []

    def add(self, template: int, end: int, length: int, at: int) -> None:
        """Words end - length to end of the text are words at - length to at of the template."""
        chains = self.open.setdefault(template, [])
        start, first = end - length, at - length
        best = None
        for c in chains:
            over = max(0, c[1] - start, c[2] - first)
            if c[1] < end and c[2] < at and over < length and start - c[1] < self.gap and first - c[2] < self.gap:
                value = c[3] + length - over
                if best is None or (value, c[0]) > (best[3], best[0]):
                    best = (c[0], end, at, value)
        if best is None:
            chains.append([start, end, at, length])
        else:
            # the chain it goes on from may go on otherwise too: it stays open until its words are too far back
            chains.append([*best])
        self.close(template, end - self.gap - length)

    def close(self, template: int, before: int | None) -> None:
        kept = []
        for c in self.open.get(template, []):
            if before is None or c[1] < before:
                self.done.append((template, *c))
            else:
                kept.append(c)
        self.open[template] = kept

    def finish(self) -> list[tuple[int, int, int, int, int]]:
        for t in list(self.open):
            self.close(t, None)
        return self.done


def scan_text(text: bytes, a: Automaton, least: int = 4, gap: int = 24) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]:
    """(n_words, [(phrase, start)], [(template, start, end, covered)]) of a whole text, which is streamed in pieces.

    The state and length of the longest match that ends at each word are the matching statistics. A match that the
    next word doesn't prolong is maximal; of at least `least` words it is chained with others."""
    step, link, longest, phrases, number = a.step, a.link, a.longest, a.phrases, a.words.get
    at, state, length = 0, 0, 0
    hits: list[tuple[int, int]] = []
    chains = Chains(gap)

    def maximal() -> None:
        # of a state's places all are alike for this length, as all its strings stand at the same places
        for template, end in a.places[state]:
            chains.add(template, at, length, end)

    for words in pieces_of(text):
        for w in map(number, words):
            if w is None:
                if length:
                    if length >= least:
                        maximal()
                    state = length = 0
            else:
                on = step[state].get(w)
                if on is None:
                    if length >= least:
                        maximal()
                    while state and w not in step[state]:
                        state = link[state]
                    length = longest[state]
                    on = step[state].get(w)
                    if on is None:
                        length = -1
                        on = 0
                state = on
                length += 1
                if phrases[state]:
                    hits.extend((p, at + 1 - n) for p, n in phrases[state] if n <= length)
            at += 1
    if length >= least:
        maximal()
    return at, hits, [(t, s, e, c) for t, s, e, _, c in chains.finish()]


def best_spans(found: list[tuple[int, int, int, int]], a: Automaton, coverage: float, enough: int) -> list[tuple[str, int, int, int, int]]:
    """(label, start, end, covered, size): chains that cover that share of their template or `enough` words of it, the best
    of those that overlap: more words covered first, then the larger share of the template, then the earlier in the text and the list."""
    fine = [x for x in found if x[3] >= min(enough, coverage * a.sizes[x[0]])]
    fine.sort(key=lambda x: (-x[3], a.sizes[x[0]], x[1], x[2], x[0]))
    taken: list[tuple[int, int]] = []
    out = []
    for t, s, e, c in fine:
        i = bisect.bisect_left(taken, (e, -1))
        if not i or taken[i - 1][1] <= s:
            bisect.insort(taken, (s, e))
            out.append((a.labels[t], s, e, c, a.sizes[t]))
    return sorted(out, key=lambda x: x[1])


def scan(df: DataFrame, automaton: Automaton, coverage: float = 0.7, enough: int = 30, least: int = 4, gap: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, base, spans, score) of each row.

    Words are runs of letters (A-Z as a-z), digits and characters beyond ASCII, counted from 0. base has (label, start, end) of every
    place of a phrase, by end and then length; spans has (label, start, end, covered, size) of disjoint stretches of text in which chained
    matches of at least `least` words, less than `gap` words apart, cover the share `coverage` of a template's `size` words, or
    `enough` of them. score is 1 if a phrase stands in the text, else the largest share of a template that a chain covers.

    The automaton, whose size build() bounds, is broadcast; rows stay where they are, and a text is streamed in pieces of 1 MB.
    Work is in proportion to a text's length and to the places that a match has in the templates.
    A null or empty text, or one without words, has n_words 0, empty arrays and score 0. Rows are independent: repeated ids and null ids each give a
    row, and an empty table an empty one. Chains that tie go to the shorter template, then to the earlier span, then to the earlier template. Columns of df other
    than id and text are not read."""
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        for batch in batches:
            for part in parts(batch, 1):
                out = []
                for text in part.column(1).cast(pa.binary()):
                    n, hits, found = scan_text(text.as_py() or b"", a, least, gap)
                    base = [{"label": a.phrase_labels[k], "start": s, "end": s + a.phrase_sizes[k]} for k, s in hits]
                    spans = [dict(zip(("label", "start", "end", "covered", "size"), x)) for x in best_spans(found, a, coverage, enough)]
                    score = 1.0 if hits else max((c / a.sizes[t] for t, _, _, c in found), default=0.0)
                    out.append((n, base, spans, score))
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(x), t) for x, t in zip(columns, _TYPES))], ["id", "n_words", "base", "spans", "score"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, base array<struct<label:string,start:bigint,end:bigint>>, spans array<struct<label:string,start:bigint,end:bigint,covered:bigint,size:bigint>>, score double"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
