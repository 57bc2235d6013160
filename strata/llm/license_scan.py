"""Licence scan: a generalised suffix automaton of licence templates.

The automaton holds every run of words of every template.  A document's words
stream through it and give matching statistics: after each word, the length of
the longest run that ends there and stands in some template.  Maximal matches
of at least ``seed`` words are chained per template when both sides advance
with gaps of at most ``gap`` words.  A run may stand at several places of a
template; each is a link of its own, put to the chain that covers most among
those within the gap, and chains stay open to other links until the text is
past them.  A chain that covers ``cover`` of its
template is a span and gives the template's label; of overlapping ones of a
template the one that covers most is kept.

Base phrases are templates too.  A phrase stands at a place exactly if the
current match is at least as long as the phrase and the phrase's state is on
the suffix-link path of the current state, so each place is counted.

Results: null or empty text, or text without words: no words, no places, empty
labels, score 0.  Repeated rows and repeated ids each give their own row.
A null id stays null.  Texts of any length stream through in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import common as C

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PIECE = 1 << 20

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Words of public licence notices, by label.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license "
        "is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission",
    ],
    "gpl": [
        "licensed under the gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
    ],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "cc-by-nc": ["licensed under cc by nc 4.0", "creative commons attribution noncommercial"],
    "cc-by-sa": ["licensed under cc by sa 4.0", "creative commons attribution sharealike"],
    "cc0": ["cc0 1.0 universal public domain dedication"],
}


class Automaton:
    """Generalised suffix automaton over word numbers; state 0 is the root."""

    def __init__(self, templates: list[list[str]]):
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]  # template -> the ends of all occurrences, ascending
        self.lengths = [len(t) for t in templates]
        self.whole: list[int] = []                    # the state that holds each whole template
        for number, template in enumerate(templates):
            last = 0
            for place, word in enumerate(template):
                last = self._extend(last, self.vocab.setdefault(word.encode(), len(self.vocab)))
                self.ends[last].setdefault(number, []).append(place + 1)
            self.whole.append(last)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.ends[self.link[state]]
            for number, places in self.ends[state].items():
                up[number] = sorted({*places, *up.get(number, ())})

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, c, known)
        new = self._state(self.size[last] + 1, {})
        at = last
        while at >= 0 and c not in self.next[at]:
            self.next[at][c] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            to = self.next[at][c]
            self.link[new] = to if self.size[to] == self.size[at] + 1 else self._split(at, c, to)
        return new

    def _state(self, size: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.size.append(size)
        self.link.append(0)
        self.ends.append({})
        return len(self.size) - 1

    def _split(self, at: int, c: int, to: int) -> int:
        """A copy of ``to`` for its shorter strings, those that ``at`` and its links lead to by ``c``."""
        copy = self._state(self.size[at] + 1, dict(self.next[to]))
        self.link[copy], self.link[to] = self.link[to], copy
        while at >= 0 and self.next[at].get(c) == to:
            self.next[at][c] = copy
            at = self.link[at]
        return copy

    def suffixes(self, state: int) -> Iterator[int]:
        while state > 0:
            yield state
            state = self.link[state]


@dataclass(frozen=True)
class Chain:
    """Matches of one template, one after the other: words of the text, the last place in the template, words covered."""
    first: int
    end: int
    place: int
    covered: int


class Scanner:
    def __init__(self, seed: int = 3, gap: int = 6, cover: float = 0.6):
        self.seed, self.gap, self.cover = seed, gap, cover
        self.labels = [label for label, texts in TEMPLATES.items() for _ in texts] + list(BASE.values())
        words = [re.findall(r"[0-9a-z]+", t) for texts in TEMPLATES.values() for t in texts]
        self.n_templates = len(words)
        base = [p.split() for p in BASE]
        self.auto = auto = Automaton(words + base)
        phrase_state = {auto.whole[self.n_templates + i]: i for i in range(len(base))}
        self.base_length = [len(p) for p in base]
        # by state: the base phrases among its suffixes
        self.phrases = [[phrase_state[s] for s in auto.suffixes(state) if s in phrase_state]
                        for state in range(len(auto.size))]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """(number of words, [(first word, phrase)], [(first, end, template, share covered)])."""
        auto = self.auto
        vocab, edges, link, size, phrases = auto.vocab.get, auto.next, auto.link, auto.size, self.phrases
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []      # (end, length, state) of maximal matches
        state = length = n = 0
        for words in _words(text):
            for word in map(vocab, words):
                n += 1
                if word is None:
                    if length >= self.seed:
                        matches.append((n - 1, length, state))
                    state = length = 0
                    continue
                was, had = state, length
                while state and word not in edges[state]:
                    state = link[state]
                    length = size[state]
                to = edges[state].get(word)
                if to is None:
                    state = length = 0
                else:
                    state, length = to, length + 1
                if length <= had and had >= self.seed:
                    matches.append((n - 1, had, was))
                for phrase in phrases[state] if length > 1 else ():
                    if self.base_length[phrase] <= length:
                        places.append((n - self.base_length[phrase], phrase))
        if length >= self.seed:
            matches.append((n, length, state))
        return n, places, self._chains(matches)

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        live: dict[int, list[Chain]] = {}
        done: dict[int, list[Chain]] = {}
        for end, length, state in matches:
            for template, places in self.auto.ends[state].items():
                if template >= self.n_templates:
                    continue
                near = []
                for chain in live.get(template, ()):
                    (near if end - length <= chain.end + self.gap else done.setdefault(template, [])).append(chain)
                fresh = []
                for place in places:
                    best, covered = None, length
                    for chain in near:
                        on, off = end - chain.end, place - chain.place
                        if off > 0 and abs(off - on) <= self.gap and chain.covered + min(length, off, on) > covered:
                            best, covered = chain, chain.covered + min(length, off, on)
                    fresh.append(Chain(best.first if best else end - length, end, place, covered))
                live[template] = near + fresh
        spans = []
        for template, chains in live.items():
            total = self.auto.lengths[template]
            taken: list[Chain] = []
            for c in sorted(chains + done.get(template, []), key=lambda c: (-c.covered, c.first, c.end)):
                if c.covered >= self.cover * total and all(c.end <= t.first or c.first >= t.end for t in taken):
                    taken.append(c)
            spans += [(c.first, c.end, template, min(1.0, c.covered / total)) for c in taken]
        return sorted(spans)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words, a piece of the text at a time; pieces end between words."""
    at = 0
    while at < len(text):
        to = min(at + PIECE, len(text))
        while to < len(text) and WORD.match(text[to:to + 1].lower()):
            to += 1
        yield WORD.findall(text[at:to].lower())
        at = to


_scanner: Scanner | None = None


def scanner() -> Scanner:
    global _scanner
    if _scanner is None:
        _scanner = Scanner()
    return _scanner


SCHEMA = ("n_words long, base_places array<struct<word: long, label: string>>, "
          "spans array<struct<first: long, end: long, label: string, share: double>>")
_ADDED = pa.schema([
    ("n_words", pa.int64()),
    ("base_places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()),
                                  ("share", pa.float64())]))),
])


def scan_licenses(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of each row with its number of words, base places and template spans."""
    keep = C.without(df.select(*keep), _ADDED.names).columns
    schema = f"{C.types_of(df.select(*keep))}, {SCHEMA}"

    def run(batches):
        scan = scanner()
        for batch in batches:
            rows = []
            for value in batch.column(len(keep)):
                n, places, spans = scan.scan(value.as_py() or b"")
                rows.append({
                    "n_words": n,
                    "base_places": [{"word": w, "label": scan.labels[scan.n_templates + p]} for w, p in places],
                    "spans": [{"first": a, "end": b, "label": scan.labels[t], "share": s} for a, b, t, s in spans],
                })
            added = pa.RecordBatch.from_pylist(rows, schema=_ADDED)
            yield pa.RecordBatch.from_arrays(batch.columns[:len(keep)] + added.columns,
                                             names=keep + _ADDED.names)

    own = C.free_name(df)
    source = C.as_bytes(df.select(*keep, df[text].alias(own)), own)
    return source.mapInArrow(run, schema)
