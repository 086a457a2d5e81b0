"""Licence scans: a generalised suffix automaton over the words of licence templates.

Files are streamed through the automaton, which gives for every word the longest run of words ending there that stands
in some template.  Long runs are chained, in the order of text and template, into spans; a span that covers enough of
its template labels the file.  Short phrases (the base) are templates found whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from twinledger.llm.common import columns_of, map_batches

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label and usual notice of well-known licences.
NOTICES = (
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation."),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software"),
    ("mit", "Released under the MIT License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Every byte that is no part of a word becomes a space.  Bytes of other than ASCII characters are all from 0x80 up.
_SPACES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cases A-Z and cuts at every ASCII character that is no letter or digit."""
    return text.encode().lower().translate(_SPACES).split()


class SuffixAutomaton:
    """All runs of words of several templates; knows where in which templates a state's run ends."""

    def __init__(self, templates: list[list[bytes]]):
        self.number: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        ends: list[set[tuple[int, int]]] = [set()]
        self.ends = ends
        for t, template in enumerate(templates):
            last = 0
            for i, word in enumerate(template):
                last = self._extend(last, self.number.setdefault(word, len(self.number)))
                ends[last].add((t, i + 1))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]
        size = len(self.number)
        self.pairs = np.zeros((size + 1, size + 1), bool)  # the last row and column are for unknown words
        for template in templates:
            known = [self.number[w] for w in template]
            self.pairs[known[:-1], known[1:]] = True

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The target of ``word`` from ``state``, cut so that its longest run is one word longer than the state's."""
        target = self.step[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def statistics(self, numbers: list[int]):
        """For every place the state and length of the longest known run of words that ends there."""
        state = length = 0
        for word in numbers:
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                length += 1
            yield state, length

    def runs(self, numbers: np.ndarray):
        """Ranges of two or more words whose neighbours all follow each other in some template: longer matches lie inside."""
        ok = np.concatenate([[False], self.pairs[numbers[:-1], numbers[1:]], [False]])
        edges = np.flatnonzero(ok[1:] != ok[:-1])
        return zip(edges[::2].tolist(), (edges[1::2] + 1).tolist())


@dataclass
class Scanner:
    """Finds phrases and template spans; ``least`` words make a long match, ``gap`` words may lie between two of them."""

    phrases: dict[str, str] = field(default_factory=lambda: dict(PHRASES))
    notices: tuple[tuple[str, str], ...] = NOTICES
    least: int = 4
    gap: int = 6
    coverage: float = 0.6

    def __post_init__(self):
        self.templates = [words(p) for p in self.phrases] + [words(n) for _, n in self.notices]
        self.labels = [*self.phrases.values(), *(label for label, _ in self.notices)]
        self.automaton = SuffixAutomaton(self.templates)
        #: of each state: the phrases that its run ends with when it is long enough.
        self.whole = [
            [(t, end) for t, end in ends if t < len(self.phrases) and end == len(self.templates[t]) <= length]
            for ends, length in zip(self.automaton.ends, self.automaton.length)
        ]
        chains = []
        for state in range(len(self.whole)):
            found, at = {}, state
            while at > 0:
                found.update(self.whole[at])
                at = self.automaton.link[at]
            chains.append(sorted(found.items()))
        self.whole = chains

    def scan(self, text: str):
        """Number of words, base places (start, phrase) and spans (first word, end, template, coverage)."""
        a = self.automaton
        found = words(text)
        unknown = len(a.number)
        numbers = np.fromiter((a.number.get(w, unknown) for w in found), "int64", len(found))
        base, anchors = [], {}
        for start, stop in a.runs(numbers) if len(found) > 1 else ():
            at, previous = start, (0, 0)
            for state, length in a.statistics(numbers[start:stop].tolist()):
                for phrase, size in self.whole[state]:
                    if size <= length:
                        base.append((at + 1 - size, phrase))
                if length <= previous[1]:
                    self._anchor(anchors, at, *previous)
                previous = state, length
                at += 1
            self._anchor(anchors, stop, *previous)
        spans = [s for t, hits in anchors.items() for s in self._chain(t, hits)]
        return len(found), sorted(base), sorted(spans)

    def _anchor(self, anchors: dict, stop: int, state: int, length: int) -> None:
        """A match that no further word prolongs, at each place of each template where it stands."""
        if length >= self.least:
            for t, end in self.automaton.ends[state]:
                if t >= len(self.phrases):
                    anchors.setdefault(t, []).append((stop - length, stop, end - length))

    def _chain(self, template: int, hits: list[tuple[int, int, int]]):
        """Joins matches that follow each other in text and template; keeps chains that cover enough of the template."""
        size = len(self.templates[template])
        chains: list[list[int]] = []  # first word, end, end in template, words covered
        for start, stop, at in sorted(hits):
            for chain in chains:
                skip = max(0, chain[1] - start, chain[2] - at)  # words that the chain has already
                if start - chain[1] <= self.gap and at + skip >= chain[2] and at - chain[2] <= self.gap and stop - start > skip:
                    chain[1], chain[2], chain[3] = stop, at + stop - start, chain[3] + stop - start - skip
                    break
            else:
                chains.append([start, stop, at + stop - start, stop - start])
            if len(chains) > 64:  # far behind: done
                done = [c for c in chains if start - c[1] > self.gap]
                chains = [c for c in chains if start - c[1] <= self.gap]
                yield from self._kept(template, size, done)
        yield from self._kept(template, size, chains)

    def _kept(self, template: int, size: int, chains):
        for first, end, _, covered in chains:
            if covered >= self.coverage * size:
                yield first, end, template, covered / size


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Every document's licences.

    Null texts count as empty: no words, no labels, score 0.  ``base_labels`` are the labels of phrases, ``labels``
    also those of template spans; ``score`` is the largest covered share of a template (a phrase is covered whole).
    ``spans`` lists template spans as label:first word:end:coverage.  Repeated rows are scanned each.
    """
    scanner = scanner or Scanner()

    def work(batches):
        for batch in batches:
            doc_ids, texts = columns_of(batch, "doc_id", "text")
            out = {n: [] for n in NAMES}
            for doc_id, text in zip(doc_ids, texts):
                n, base, spans = scanner.scan(text or "")
                own = {scanner.labels[t] for _, t in base}
                label = scanner.labels
                row = (
                    doc_id, n, len(base), base[0][0] if base else None, base[-1][0] if base else None,
                    ",".join(sorted(own)), ",".join(sorted(own | {label[t] for _, _, t, _ in spans})),
                    max([1.0 if base else 0.0, *(c for _, _, _, c in spans)]),
                    ",".join(f"{label[t]}:{a}:{b}:{c:.3f}" for a, b, t, c in spans),
                )
                for name, value in zip(NAMES, row):
                    out[name].append(value)
            yield out

    return map_batches(docs.select("doc_id", "text"), work, SCHEMA)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans string"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
