"""License scan: matching statistics of a generalised suffix automaton, chained into spans.

The automaton holds the token sequences of all templates. A text's words are streamed through it:
after each word it knows the longest run of words ending there that stands in some template, and
in which templates. Runs of LEAST_MATCH words or more are kept per template and chained while text
and template positions both go on with gaps of at most MOST_GAP words. A chain that covers
LEAST_COVER of a template is a covered span and gives the template's label. The three base phrases
are templates too: each place where one stands is a suffix of the run at its last word.

Most words are in no template. They put the automaton back to its root, so only stretches whose
neighbouring words are neighbours in some template are streamed; no other stretch holds a run of
two words.

Null or empty text has no words: counts 0, places null, no labels, score 0. Repeated rows and ids
are each answered on their own; other columns are ignored. Work and memory are linear in a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import arrow_pass, ascii_lower, batch_of

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Openings and grants of public licenses, by label.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved-notice": "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means",
}
TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LEAST_MATCH, MOST_GAP, LEAST_COVER = 4, 8, 0.6
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first: long, last: long, cover: double>>"


def tokens(text: str) -> list[bytes]:
    return TOKEN.findall(ascii_lower(text.encode()))


class SuffixAutomaton:
    """Generalised over several token sequences; states know where their runs end, per sequence."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]  # sequence -> first place where the run ends
        for which, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].setdefault(which, at)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            up = self.ends[self.link[state]]
            for which, at in self.ends[state].items():
                up[which] = min(up.get(which, at), at)

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """The copy of ``target`` for runs that are one longer than ``state``'s."""
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, token, known)
        new, state = self._new(self.length[last] + 1, 0, {}), last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, token, target)
        return new

    def step(self, state: int, length: int, token: int) -> tuple[int, int]:
        """Longest run after one more token."""
        while state and token not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if token in self.next[state]:
            return self.next[state][token], length + 1
        return 0, 0

    def find(self, sequence: list[int]) -> int:
        state = 0
        for token in sequence:
            state = self.next[state][token]
        return state


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.labels = [*phrases.values(), *templates]
        sequences = [tokens(t) for t in [*phrases, *templates.values()]]
        self.ids = {w: i for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s), 1)}
        self.sequences = [[self.ids[w] for w in s] for s in sequences]
        self.automaton = SuffixAutomaton(self.sequences)
        self.beside = np.zeros((len(self.ids) + 1,) * 2, bool)
        for s in self.sequences:
            self.beside[s[:-1], s[1:]] = True
        self.phrases = range(len(phrases))
        #: State -> base phrases that are a suffix of its runs, if these are long enough.
        self.suffixes: list[list[int]] = [[] for _ in self.automaton.link]
        at = {self.automaton.find(self.sequences[p]): p for p in self.phrases}
        for state in sorted(range(1, len(self.suffixes)), key=lambda s: self.automaton.length[s]):
            own = [at[state]] if state in at else []
            self.suffixes[state] = self.suffixes[self.automaton.link[state]] + own

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], dict[int, list[tuple[int, int, int]]]]:
        """Places (phrase, first word), and per template its runs (first, last, template place of last)."""
        places: list[tuple[int, int]] = []
        runs: dict[int, list[tuple[int, int, int]]] = {}
        if len(words) < 2:
            return places, runs
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        pairs = self.beside[ids[:-1], ids[1:]]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], pairs, [False])).view(np.int8)))
        step, ends = self.automaton.step, self.automaton.ends
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            state, length, stretch = 0, 0, ids[first : last + 1].tolist()
            before: tuple[int, int] = (0, 0)
            for i, token in enumerate([*stretch, 0]):
                state, length = step(state, length, token)
                if length <= before[1] and before[1] >= LEAST_MATCH:  # the run before was as long as it gets
                    for which, at in ends[before[0]].items():
                        if which not in self.phrases:
                            runs.setdefault(which, []).append((first + i - before[1], first + i - 1, at))
                for p in self.suffixes[state]:
                    if length >= len(self.sequences[p]):
                        places.append((p, first + i - len(self.sequences[p]) + 1))
                before = state, length
        return places, runs

    def spans(self, runs: dict[int, list[tuple[int, int, int]]]) -> list[tuple[str, int, int, float]]:
        """Chains of each template's runs that cover enough of it."""
        out = []
        for which, found in runs.items():
            total = len(self.sequences[which])
            chain: list[tuple[int, int, int]] = []
            for first, last, at in [*found, (1 << 60, 1 << 60, 0)]:
                start = at - (last - first)
                if chain and not (chain[-1][1] < first <= chain[-1][1] + MOST_GAP + 1 and chain[-1][2] < start <= chain[-1][2] + MOST_GAP + 1):
                    cover = sum(b - a + 1 for a, b, _ in chain) / total
                    if cover >= LEAST_COVER:
                        out.append((self.labels[which], chain[0][0], chain[-1][1], min(1.0, cover)))
                    chain = []
                chain.append((first, last, at))
        return sorted(out, key=lambda s: (s[1], s[2], s[0]))

    def row(self, doc_id: int | None, text: str | None) -> tuple:
        words = tokens(text or "")
        places, runs = self.matches(words)
        starts = [at for _, at in places]
        spans = self.spans(runs)
        base = sorted({self.labels[p] for p, _ in places})
        every = sorted({*base, *(s[0] for s in spans)})
        # A base phrase is a whole template, so it scores as a full cover.
        score = 1.0 if places else max((s[3] for s in spans), default=0.0)
        named = [dict(zip(("label", "first", "last", "cover"), s)) for s in spans]
        return doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(every), score, named


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(templates))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Columns of SCHEMA, one row for each row of ``docs``."""
    key = tuple(phrases.items()), tuple(templates.items())
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())]))
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), span]
    names = [c.strip().split()[0] for c in SCHEMA.split(", spans")[0].split(",")] + ["spans"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*key)
        for batch in batches:
            made = [scanner.row(d, t) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            columns = list(zip(*made)) or [()] * len(kinds)
            yield batch_of({n: (list(c), k) for n, c, k in zip(names, columns, kinds)})

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), rows, SCHEMA)
