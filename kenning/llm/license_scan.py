"""License scan: winnowed fingerprints in an inverted index, then banded alignment.

Templates (a parameter of any size; the index travels with the task) are indexed by
fingerprints: hashes of ``GRAM`` words of which winnowing keeps the least of every
``WINNOW`` neighbours, in templates and texts alike, so that a shared run of
GRAM + WINNOW - 1 = 4 words shares a fingerprint. An occurrence that differs from its
template by at most a fifth of the template's words (replaced, left out or added) has
such a run. Templates of up to ``SHORT`` words have runs too short for that; all their
words are indexed instead, and a window of the text is a candidate if it holds as many
of their distinct words as an occurrence must.

Hits of one template are chained by diagonal (place in the text less place in the
template): hits whose diagonals lie within a quarter of the template of each other are
one candidate. It is dropped if the part of the text around it has too few of the
template's words, each counted as often as both have it; else template and text are
aligned in the band of its diagonals, a quarter of the template wider on both sides
(match +1, mismatch, insertion and deletion -1). The matched share of the template and
the span in the text are reported if at least ``LEAST`` of the template's words match;
the words before, between and after the spans found are aligned again, so notices that
follow each other are each found.

Words are runs of letters, digits and inner dots or hyphens, in lower case (ASCII).
Where several templates match one span, all are reported; of overlapping spans of
the same template the best is, of equally good ones the first.

Defined results: a null, empty or unrelated text has no rows; a text that states a
license twice has two rows; rows that repeat are each scanned; an empty table or an
empty template list gives no rows; other columns are ignored. A very long text is
scanned whole, with some 50 bytes a word in its task.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import text_bytes

LEAST = 0.8
SHORT = 64
GRAM = 3
WINNOW = 2
# A template's words must fit the packed alignment.
MAX_WORDS = 1 << 20
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+(?:[.-][a-z0-9\x80-\xff]+)*")

# Short public license notices and the opening terms of common licenses.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "mit-terms": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                 "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-terms": "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-terms": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                 "later version.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-terms": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "Released under CC0 1.0.",
}


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _fingerprints(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the winnowed grams; grams with an unknown word (code 0) have none."""
    n = len(codes) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(GRAM):
        part = codes[k:k + n]
        known &= part != 0
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h[~known] = np.iinfo(np.uint64).max
    wide = np.lib.stride_tricks.sliding_window_view(h, min(WINNOW, n))
    place = np.unique(wide.argmin(axis=1) + np.arange(len(wide)))
    place = place[known[place]]
    return h[place], place


class Index:
    """Word codes, template words, the inverted index of the short templates' words and
    that of the long templates' fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        words = [words_of(t.encode()) for t in templates.values()]
        if any(len(ws) >= MAX_WORDS for ws in words):
            raise ValueError(f"a template has {MAX_WORDS} words or more")
        self.code = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws), 1)}
        self.codes = [np.array([self.code[w] for w in ws], np.uint64) for ws in words]
        self.places: dict[int, list[int]] = defaultdict(list)  # per code the short templates with that word
        self.need = []  # distinct words that an occurrence of each template has at least
        hashes, owner, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for t, codes in enumerate(self.codes):
            own = sorted(set(codes.tolist()))
            self.need.append(len(own) - sum(1 for k in range(len(codes)) if k >= LEAST * len(codes)))
            if len(codes) <= SHORT:
                for c in own:
                    self.places[c].append(t)
            else:
                h, at = _fingerprints(codes)
                hashes.append(h)
                owner.append(np.full(len(h), t))
                place.append(at)
        self.hashes, self.owner, self.place = map(np.concatenate, (hashes, owner, place))
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owner, self.place = self.hashes[order], self.owner[order], self.place[order]

    def chains(self, codes: np.ndarray):
        """(template, start, end, lowest and highest diagonal from start) of the
        candidates of the long templates."""
        if not len(self.hashes):
            return
        h, at = _fingerprints(codes)
        first, last = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, "right")
        n = last - first
        hit = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        template, diagonal = self.owner[hit], np.repeat(at, n) - self.place[hit]
        order = np.lexsort((diagonal, template))
        template, diagonal = template[order], diagonal[order]
        for t in np.unique(template).tolist():
            own, size = diagonal[np.searchsorted(template, t):np.searchsorted(template, t, "right")], len(self.codes[t])
            band = size // 4 + 1
            want = np.bincount(self.codes[t].astype(np.int64))
            for part in np.split(own, np.flatnonzero(np.diff(own) > band) + 1):
                low, high = int(part[0]) - band, int(part[-1]) + band
                start, end = max(0, low), min(len(codes), high + size)
                held = np.bincount(codes[start:end].astype(np.int64), minlength=len(want))[:len(want)]
                if np.minimum(held, want)[1:].sum() >= LEAST * size:
                    yield t, start, end, low - start, high - start

    def regions(self, codes: np.ndarray):
        """(template, start, end) of the parts of the text, apart from each other, that
        hold all occurrences of the short templates."""
        seen: dict[int, int] = defaultdict(int)
        for c in np.unique(codes).tolist():
            for t in self.places.get(c, ()):
                seen[t] += 1
        for t, n in seen.items():
            if n < self.need[t]:
                continue
            step = 2 * len(self.codes[t])
            at = np.flatnonzero(np.isin(codes, self.codes[t]))
            block, word = at // step, codes[at].astype(np.int64)
            # window k is the blocks k - 1 and k
            found = np.unique(np.concatenate([block, block + 1]) * (len(self.code) + 1) + np.concatenate([word, word]))
            window, n = np.unique(found // (len(self.code) + 1), return_counts=True)
            spans: list[list[int]] = []
            for k in window[n >= self.need[t]].tolist():
                if spans and (k - 1) * step <= spans[-1][1]:
                    spans[-1][1] = (k + 1) * step
                else:
                    spans.append([max(0, k - 1) * step, (k + 1) * step])
            for start, end in spans:
                yield t, start, min(len(codes), end)

    def scan(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(template, first word, end word, matched words) of every occurrence."""
        words = words_of(text)
        get = self.code.get
        codes = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        out = []
        for t, start, end in self.regions(codes):
            out += [(t, start + s, start + e, m) for s, e, m in occurrences(self.codes[t], codes[start:end])]
        long: dict[int, list] = defaultdict(list)
        for t, start, end, low, high in self.chains(codes):
            long[t] += [(start + s, start + e, m) for s, e, m in occurrences(self.codes[t], codes[start:end], low, high)]
        for t, spans in long.items():  # bands of neighbouring chains overlap
            kept: list[tuple[int, int, int]] = []
            for s, e, m in sorted(set(spans), key=lambda x: (-x[2], x[0])):
                if all(e <= k[0] or k[1] <= s for k in kept):
                    kept.append((s, e, m))
            out += [(t, *k) for k in kept]
        return sorted(out, key=lambda x: (x[1], x[0]))


# An alignment as one number: score, matched words, and the fewer words of the text the larger.
_SCORE, _MATCH, _FRESH = 1 << 42, 1 << 21, (1 << 21) - 1


def best_ends(template: np.ndarray, text: np.ndarray, low: int | None = None, high: int | None = None) -> np.ndarray:
    """Per word of the text the best alignment (as one number) of a part of the template
    with a part of the text that ends there in a match: match +1, anything else -1,
    never below zero; only diagonals (text less template) from ``low`` to ``high``."""
    n = len(text)
    low, high = -len(template) if low is None else low, n if high is None else high
    best = np.zeros(n, np.int64)
    slope = np.arange(n, dtype=np.int64) * (_SCORE + 1)
    above = np.full(n + 1, _FRESH, np.int64)  # at j + 1: ends at word j
    for i, a in enumerate(template):
        s, e = max(0, i + low), min(n, i + high + 1)
        if s >= e:
            continue
        same = text[s:e] == a
        row = above[s:e] + np.where(same, _SCORE + _MATCH - 1, -_SCORE - 1)
        part = best[s:e]
        np.maximum(part, row, out=part, where=same)
        np.maximum(row, above[s + 1:e + 1] - _SCORE, out=row)
        row = np.maximum.accumulate(row + slope[s:e]) - slope[s:e]  # words of the text that are inserted
        above[s + 1:e + 1] = np.where(row < _SCORE, _FRESH, row)
        above[s] = _FRESH  # left of the band
    return best


def occurrences(template: np.ndarray, text: np.ndarray, low: int | None = None,
                high: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, matched words) of the spans with at least ``LEAST`` of the template's
    words matched, best first, none overlapping: what lies before, between and after
    the spans found is aligned again until nothing more is found. A span must score
    better than any part of it; words that only make up for a gap do not belong to it."""
    least = LEAST * len(template)
    band = (-len(template) if low is None else low, len(text) if high is None else high)
    out, parts = [], [(0, len(text))]
    while parts:
        low, high = parts.pop()
        if high - low < least:
            continue
        best = best_ends(template, text[low:high], band[0] - low, band[1] - low)
        matched = best % _SCORE // _MATCH
        at = np.flatnonzero((matched >= least) & (matched > 0))
        free, found = np.ones(high - low, bool), []
        for j in at[np.argsort(-best[at], kind="stable")].tolist():
            start = j + 1 - (_FRESH - int(best[j]) % _MATCH)
            inner = best[start:j]
            inner = inner[np.arange(start + 1, j + 1) - (_FRESH - inner % _MATCH) >= start]
            if free[start:j + 1].all() and not (inner // _SCORE >= best[j] // _SCORE).any():
                free[start:j + 1] = False
                found.append((low + start, low + j + 1, int(matched[j])))
        if found:
            found.sort()
            out += found
            parts += zip([low, *[e for _, e, _ in found]], [*[s for s, _, _ in found], high])
    return sorted(out)


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, str] | None = None) -> DataFrame:
    """One row per occurrence: id, ``license``, ``first_word``, ``end_word`` (span in words of
    the text, end exclusive), ``matched`` (words), ``coverage`` (share of the template)."""
    index = Index(TEMPLATES if templates is None else templates)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            at, rows = [], []
            for i, t in enumerate(text_bytes(b.column(1))):
                got = index.scan(t)
                at += [i] * len(got)
                rows += got
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array([index.names[r[0]] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([r[3] / len(index.codes[r[0]]) for r in rows], pa.float64())],
                ["id", "license", "first_word", "end_word", "matched", "coverage"])

    schema = (f"id {src.schema['id'].dataType.simpleString()}, license string, first_word bigint, end_word bigint, "
              "matched bigint, coverage double")
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
