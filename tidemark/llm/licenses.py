"""License scan: matching statistics against a generalised suffix automaton of license tokens.

All templates (license notices and base phrases) go into one suffix automaton over words.  A file is
streamed through it: after each word the state and length give the longest suffix that stands in
some template (the matching statistics).  Words in no template leave the automaton at its root, so only
stretches of known words are walked.
* A base phrase ends at a word if it is a suffix of the current match: a table from states answers that.
* Each template's own maximal matches of at least ``min_match`` words (or of the whole template) are chained, in
  template order and with bounded gaps; a chain that covers at least ``cover`` of its template's words is a covered
  span, and labels the file.  A template's match may lie inside a longer match of another template: the states
  down the suffix links have those places.

The automaton is built once on the driver (some hundred words) and sent with the tasks; documents are
scanned once and never shuffled.

Defined results: a null text is empty; an empty text has no words, no labels and score 0; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, each, ship, text_or_empty

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Passages of public license texts and notices, by label.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software",
        "Released under the MIT License", "Licensed under the MIT License",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Apache License, Version 2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Licensed under the BSD License",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "GNU General Public License",
    ),
    "lgpl": ("GNU Lesser General Public License",),
    "agpl": ("GNU Affero General Public License",),
    "mpl-2": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted",
    ),
    "cc-by-nc": ("Creative Commons Attribution NonCommercial", "licensed under CC BY-NC 4.0"),
    "cc-by-sa": ("Creative Commons Attribution ShareAlike", "licensed under CC BY-SA 4.0"),
    "cc-by": ("Creative Commons Attribution 4.0 International License", "licensed under CC BY 4.0"),
    "cc0": ("CC0 1.0 Universal Public Domain Dedication",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "all-rights-reserved": ("All rights reserved",),
}
_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


class Automaton:
    """Generalised suffix automaton of word sequences (online construction, a template at a time)."""

    def __init__(self, templates: list[list[str]]):
        self.templates = templates
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]      # (template, end) whose prefix is longest here
        for t, ws in enumerate(templates):
            last = 0
            for i, w in enumerate(ws):
                last = self._extend(last, w)
                self.ends[last].append((t, i + 1))
        # all (template, end) of a state: its own and those of the states that extend its suffixes
        order = sorted(range(1, len(self.next)), key=lambda s: -self.length[s])
        self.places = [list(e) for e in self.ends]
        for s in order:
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]
        # suffix chain from each state: complete templates that end there
        self.complete: list[list[int]] = [[] for _ in self.next]
        for s in sorted(range(len(self.next)), key=lambda s: self.length[s]):
            own = [t for t, e in self.ends[s] if e == len(templates[t])]
            self.complete[s] = own + (self.complete[self.link[s]] if self.link[s] >= 0 else [])

    def _new(self, length: int, copy: int | None = None) -> int:
        self.next.append({} if copy is None else dict(self.next[copy]))
        self.link.append(-1 if copy is None else self.link[copy])
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, w: str, q: int) -> int:
        clone = self._new(self.length[p] + 1, q)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: str) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._new(self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, base: dict[str, str] = BASE,
                 min_match: int = 3, cover: float = 0.8, gap: int = 3):
        self.min_match, self.cover, self.gap = min_match, cover, gap
        texts = [(label, p, True) for p, label in base.items()]
        texts += [(label, p, False) for label, ps in templates.items() for p in ps]
        self.labels = [label for label, _, _ in texts]
        self.is_base = [b for _, _, b in texts]
        self.auto = Automaton([words(p) for _, p, _ in texts])
        self.known = set(self.auto.next[0])
        self.sizes = [len(t) for t in self.auto.templates]
        # complete base phrases as (phrase, words) by state
        self.phrases = [[t for t in c if self.is_base[t]] for c in self.auto.complete]
        # complete templates of fewer than min_match words by state
        self.short = [[t for t in c if not self.is_base[t] and self.sizes[t] < min_match] for c in self.auto.complete]
        self._top: dict[int, list] = {}
        self._below: dict[int, list] = {}

    def _by_next(self, places: list[tuple[int, int]]) -> list[tuple[str, list[tuple[int, int]]]]:
        """Places of templates (no base phrases) by the template's next word, "" at its end."""
        out: dict[str, list[tuple[int, int]]] = {}
        for t, e in places:
            if not self.is_base[t]:
                own = self.auto.templates[t]
                out.setdefault(own[e] if e < len(own) else "", []).append((t, e))
        return list(out.items())

    def pieces(self, end: int, size: int, state: int, after: str | None) -> list[tuple[int, int, int, int]]:
        """(template, start, start in the template, words) of the templates' own maximal matches that end here.

        ``after`` is the file's next word: a place whose template goes on with it is not maximal.
        """
        auto, out = self.auto, []
        if state not in self._top:
            self._top[state] = self._by_next(auto.places[state])
        groups = self._top[state]
        while size >= self.min_match:
            for word, own in groups:
                if word != after:
                    out += [(t, end - size, e - size, size) for t, e in own]
            if state not in self._below:            # places that match the link's words and no more
                here = set(auto.places[state])
                below = auto.places[auto.link[state]] if auto.link[state] > 0 else []
                self._below[state] = self._by_next([x for x in below if x not in here])
            groups, state = self._below[state], auto.link[state]
            size = auto.length[state]
        return out

    def matches(self, ws: list[str]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]],
                                              list[tuple[int, int, int, int]]]:
        """Base places (template, start), maximal matches (end, length, state) of ``min_match`` words or more, pieces."""
        auto, known = self.auto, self.known
        places, long_, pieces, state, size, n = [], [], [], 0, 0, len(ws)
        for i, w in enumerate(ws):
            if w not in known:
                if size >= self.min_match:
                    long_.append((i, size, state))
                state = size = 0
                continue
            before, was = state, size
            while state and w not in auto.next[state]:
                state = auto.link[state]
                size = auto.length[state]
            if size < was and was >= self.min_match:
                long_.append((i, was, before))
            state = auto.next[state][w]
            size += 1
            for t in self.phrases[state]:
                if size >= self.sizes[t]:
                    places.append((t, i + 1 - self.sizes[t]))
            for t in self.short[state]:
                if size >= self.sizes[t]:
                    pieces.append((t, i + 1 - self.sizes[t], 0, self.sizes[t]))
            if size >= self.min_match:
                pieces += self.pieces(i + 1, size, state, ws[i + 1] if i + 1 < n else None)
        if size >= self.min_match:
            long_.append((n, size, state))
        return places, long_, pieces

    def spans(self, pieces: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Covered template spans (label, start word, end word, share of the template), by chaining pieces."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for t, at, in_t, size in pieces:
            by_template.setdefault(t, []).append((at, in_t, size))
        out = []
        for t, own in by_template.items():
            # best chain ending in each piece: later in the file, later in the template, small gaps
            own.sort()
            best: list[tuple[int, int]] = []            # covered words, first word of the chain
            longest, low = max(size for _, _, size in own), 0
            for k, (at, in_t, size) in enumerate(own):
                top = (size, at)
                while own[low][0] + longest < at - self.gap:        # these and all before end too early
                    low += 1
                for j in range(low, k):
                    a, b, s = own[j]
                    over = max(0, a + s - at, b + s - in_t)
                    if a < at and b < in_t and over < size and at - a - s <= self.gap and in_t - b - s <= self.gap:
                        top = max(top, (best[j][0] + size - over, best[j][1]), key=lambda x: x[0])
                best.append(top)
            for (covered, first), (at, _, size) in zip(best, own, strict=True):
                if covered >= self.cover * self.sizes[t]:
                    out.append((self.labels[t], first, at + size, min(1.0, covered / self.sizes[t])))
        return out

    def scan(self, text: str) -> dict:
        ws = words(text)
        places, _, pieces = self.matches(ws)
        starts = [s for _, s in places]
        spans = self.spans(pieces)
        base = sorted({self.labels[t] for t, _ in places})
        score = max([x[3] for x in spans], default=0.0)
        return {"n_words": len(ws), "n_base": len(places), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": ",".join(base),
                "labels": ",".join(sorted({*base, *(x[0] for x in spans)})), "score": 1.0 if places else score,
                "spans": [{"label": a, "start": b, "end": c, "share": d} for a, b, c, d in sorted(set(spans))]}


_FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
           ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
           ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                         ("share", pa.float64())])))]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    ship(docs.sparkSession)
    scanner = scanner or Scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scanner.scan(t) for t in each(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([r[f] for r in rows], kind) for f, kind in _FIELDS]],
                names=[id_col, *[f for f, _ in _FIELDS]])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double, spans array<struct<label string, start long, end long, share double>>")


def op1_license_scan(spark, sf_dir):
    return scan_licenses(documents(spark, sf_dir)).drop("spans")
