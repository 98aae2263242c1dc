"""Licence scan by a generalised suffix automaton of licence texts, word by word.

The automaton holds every run of words of every template. A text is streamed through it: at
each word it knows the longest run that ends there and is in some template (the matching
statistics). Runs of ``MIN_RUN`` words or more that cannot be extended are chained, template by
template, in the order of both texts; a chain that covers ``MIN_COVER`` of its template is a
finding with its span. The base phrases are templates too, and are found at every place.

The automaton is built from the templates alone and goes with the task; texts are streamed
whole, one at a time.

Defined results: null text is empty: no words, no places, null places, empty labels, score 0.
Repeated rows are scanned each for itself. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrase to label. Fixed values.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# (label, text) of licence notices, as their publishers word them. Fixed values.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
)
MIN_RUN = 4
MIN_COVER = 0.75
MAX_GAP = 20

# ASCII letters lower-cased, other ASCII but digits as blanks; bytes of other characters stay.
_WORDS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
_RUN = re.compile(rb"\x01{2,}")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences. State 0 is the empty run."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.final: list[int] = []  # the state of each whole sequence
        ends: list[list[tuple[int, int]]] = [[]]  # (sequence, place after its last word)
        for s, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence, 1):
                last = self._extend(last, word)
                ends += [[] for _ in range(len(self.next) - len(ends))]
                ends[last].append((s, place))
            self.final.append(last)
        # A run also ends wherever a longer run that it is the end of does.
        for state in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            ends[self.link[state]] += ends[state]
        ends[0] = []
        self.ends = ends
        self.words = {w for s in sequences for w in s}

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes) -> int:
        """The state of exactly the run of p and word, which some longer state stands for."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:  # another sequence has this run
            return self._split(last, word)
        state, p = self._state(self.length[last] + 1), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        self.link[state] = 0 if p < 0 else self._split(p, word)
        return state

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Per word: (state, length) of the longest run of a sequence that ends there."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length


class Scanner:
    def __init__(self, phrases=None, templates=TEMPLATES):
        phrases = PHRASES if phrases is None else phrases
        self.labels = [*phrases.values(), *[label for label, _ in templates]]
        self.sequences = [words_of(t) for t in [*phrases, *[t for _, t in templates]]]
        self.automaton = Automaton(self.sequences)
        n = len(phrases)
        # Per state, the phrases that its runs end with: its own and those of shorter ends.
        states = self.automaton.length
        self.phrases: list[list[int]] = [[] for _ in states]
        for state in sorted(range(1, len(states)), key=states.__getitem__):
            own = [s for s in range(n) if self.automaton.final[s] == state]
            self.phrases[state] = self.phrases[self.automaton.link[state]] + own
        self.notices = [[(s, p) for s, p in ends if s >= n] for ends in self.automaton.ends]

    def scan(self, words: list[bytes]):
        """(places, findings): places (start, label) of phrases; findings (label, cover, start,
        end) of chains of runs, covering a share of their template."""
        known = self.automaton.words
        marks = bytes([w in known for w in words])
        places, chains, findings = [], {}, []
        for stretch in _RUN.finditer(marks):
            at, end = stretch.span()
            self._stretch(words[at:end], at, places, chains, findings)
        for s, chain in chains.items():
            self._close(s, chain, findings)
        return places, findings

    def _stretch(self, words, at, places, chains, findings):
        before = (0, 0)
        for k, (state, length) in enumerate(self.automaton.statistics(words)):
            if length != before[1] + 1 and before[1] >= MIN_RUN:
                self._chain(before, at + k, chains, findings)
            for s in self.phrases[state]:
                n = len(self.sequences[s])
                if n <= length:
                    places.append((at + k + 1 - n, self.labels[s]))
            before = (state, length)
        if before[1] >= MIN_RUN:
            self._chain(before, at + len(words), chains, findings)

    def _chain(self, run, end, chains, findings):
        """Adds a run that ends before word ``end`` to the chain of each template that has it.
        A chain: start, end in the text; end in the template; words covered."""
        state, length = run
        for s, place in self.notices[state]:
            chain = chains.get(s)
            if chain and place > chain[2] and 0 < end - chain[1] <= MAX_GAP + length:
                fresh = min(length, place - chain[2], end - chain[1])
                chains[s] = (chain[0], end, place, chain[3] + fresh)
                continue
            if chain:
                self._close(s, chain, findings)
            chains[s] = (end - length, end, place, length)

    def _close(self, s, chain, findings):
        start, end, _, covered = chain
        findings.append((self.labels[s], covered / len(self.sequences[s]), start, end))


def scanned(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Per document: doc_id, n_words, places (start, label) of base phrases, and findings
    (label, cover, start, end) in words, of every chain that covers enough of its template, with
    the best cover of any chain as ``best``."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        for batch in batches:
            rows = []
            for t in batch["text"]:
                words = words_of(t)
                places, found = scanner.scan(words)
                best = max([f[1] for f in found], default=0.0)
                rows.append((len(words), places, [f for f in found if f[1] >= MIN_COVER], best))
            out = pd.DataFrame(rows, columns=["n_words", "places", "findings", "best"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        scan,
        f"doc_id {kind}, n_words long, places array<struct<start:long,label:string>>, "
        "findings array<struct<label:string,cover:double,start:long,end:long>>, best double",
    )


def digest(found: DataFrame) -> DataFrame:
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, own = F.col("places.label"), F.col("findings.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.least("best", F.lit(1.0))).alias("score"),
    )
