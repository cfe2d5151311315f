"""License scans: winnowed template fingerprints pick candidates, banded alignment measures them.

Templates are short, so their inverted index (word triple to template and place) has a bounded size and travels
with the tasks. Of each two neighbouring triples of a template the one with the smaller hash is indexed, so any
shared run of four words meets the index. Templates of which the least coverage need not leave such a run are indexed by
all their triples, or by all their pairs, where two hits make a candidate. All triples and pairs of a text are looked up. Hits of one template that lie close
in the text and near one diagonal are one candidate; a local alignment in a band around those diagonals counts the
matched words and finds the span. Where spans overlap, the better alignment stays.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import table

# Public license notices, as license id and text.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

GRAM, WINNOW, BAND, LEAST_COVERAGE = 3, 2, 8, 0.8
MOST_TEMPLATE_WORDS = 1_000_000  # all templates together; the index travels with the tasks
GAP = 0.5
WORD = re.compile(r"\w+")


class Index:
    """The templates' words and the inverted index of their winnowed triples."""

    def __init__(self, templates: Sequence[tuple[str, str]], least: float = 0.8):
        self.vocabulary: dict[str, int] = {}
        self.names, self.words, places, pairs = [], [], defaultdict(list), defaultdict(list)
        self.by_pairs: set[int] = set()
        for name, text in templates:
            found = [self.vocabulary.setdefault(w.lower(), len(self.vocabulary) + 1) for w in WORD.findall(text)]
            self.names.append(name)
            self.words.append(np.array(found, np.int64))
        if sum(map(len, self.words)) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates have over {MOST_TEMPLATE_WORDS} words; scan them in several runs")
        self.base = len(self.vocabulary) + 1
        for number, words in enumerate(self.words):
            run = shortest_run(len(words), least)
            if run < GRAM:
                self.by_pairs.add(number)
                for at in range(len(words) - 1):
                    pairs[int(words[at] * self.base + words[at + 1])].append((number, at))
                continue
            grams = self.grams(words)
            marks = [zlib.crc32(int(g).to_bytes(16, "little")) for g in grams]
            winnow = WINNOW if run >= GRAM + WINNOW - 1 else 1
            for at in range(max(1, len(grams) - winnow + 1)) if len(grams) else ():
                window = range(at, min(at + winnow, len(grams)))
                chosen = min(window, key=lambda i: (marks[i], -i))
                if (number, chosen) not in places[int(grams[chosen])]:
                    places[int(grams[chosen])].append((number, chosen))
        self.tables = [(np.array(sorted(x), np.int64), [x[k] for k in sorted(x)]) for x in (places, pairs)]

    def grams(self, words: np.ndarray) -> np.ndarray:
        return (words[:-2] * self.base + words[1:-1]) * self.base + words[2:] if len(words) >= GRAM else np.zeros(0, np.int64)

    def hits(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, place in it, place in the text)."""
        out = []
        for size, (keys, places) in zip((GRAM, GRAM - 1), self.tables):
            if len(words) < size or not len(keys):
                continue
            known = np.flatnonzero(np.logical_and.reduce([words[i : len(words) - size + 1 + i] > 0 for i in range(size)]))
            grams = self.grams(words) if size == GRAM else words[:-1] * self.base + words[1:]
            at = np.minimum(np.searchsorted(keys, grams[known]), len(keys) - 1)
            same = keys[at] == grams[known]
            out += [(t, p, int(q)) for q, a in zip(known[same], at[same]) for t, p in places[a]]
        return out


def shortest_run(n: int, least: float) -> int:
    """Words in a row that ``least`` of ``n`` words matched must at least leave, if the others are replaced."""
    matched = ceil(least * n - 1e-9)
    return -(-matched // (n - matched + 1))


def candidates(hits: list[tuple[int, int, int]], index: Index) -> list[tuple[int, int, int]]:
    """(template, lowest and highest diagonal) of each chain of hits: a hit joins the nearest open chain of its template
    whose diagonal one band can hold together with its own and that has come less far in the template; else it opens one. A chain closes a template's
    length after its last hit, so a text that repeats a license has a chain for each time."""
    chains, open_ = [], defaultdict(list)
    for q, p, t in sorted((q, p, t) for t, p, q in hits):
        diagonal = q - p
        open_[t] = [c for c in open_[t] if q - c[4] <= len(index.words[t]) + BAND]
        near = [c for c in open_[t] if c[3] < p and abs(c[5] - diagonal) <= 2 * BAND]
        if near:
            chain = min(near, key=lambda c: abs(c[5] - diagonal))
            chain[1:] = [min(chain[1], diagonal), max(chain[2], diagonal), p, q, diagonal, chain[6] + 1]
        else:
            chain = [t, diagonal, diagonal, p, q, diagonal, 1]
            open_[t].append(chain)
            chains.append(chain)
    return [(t, low, high) for t, low, high, _, _, _, hits_ in chains if hits_ > 1 or t not in index.by_pairs]


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[float, int, int, int]:
    """Score, matched words, first and last word + 1 in the text of the best local alignment whose diagonals (text
    minus template) lie between ``low`` and ``high``, widened by the band. A match gains 1, a mismatch or gap loses half."""
    low, high = low - BAND, high + BAND
    width, steps = high - low + 1, GAP * np.arange(high - low + 2)
    score = np.zeros((len(template) + 1, width + 1))
    for i, word in enumerate(template, 1):
        at = i - 1 + low + np.arange(width)  # text place on each diagonal
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == word
        # On diagonals, the step along both is the same column, a skipped template word the next, a skipped text word the one before.
        best = np.maximum(score[i - 1, :width] + np.where(same, 1.0, -GAP), score[i - 1, 1:] - GAP)
        best = np.where(inside, np.maximum(best, 0), 0)
        score[i, :width] = np.maximum.accumulate(best + steps[:width]) - steps[:width]
    i, j = np.unravel_index(int(score[:, :width].argmax()), (len(template) + 1, width))
    top, matched, end = float(score[i, j]), 0, int(i + low + j)
    begin = end
    while i > 0 and score[i, j] > 0:
        at = i - 1 + low + j
        same = 0 <= at < len(text) and text[at] == template[i - 1]
        if np.isclose(score[i, j], score[i - 1, j] + (1.0 if same else -GAP)):
            i, matched, begin = i - 1, matched + same, at if same else begin
        elif j + 1 < width and np.isclose(score[i, j], score[i - 1, j + 1] - GAP):
            i, j = i - 1, j + 1
        elif j > 0 and np.isclose(score[i, j], score[i, j - 1] - GAP):
            j -= 1
        else:
            break
    return top, int(matched), int(begin), int(end)


def scan_text(text: str, index: Index, least: float = LEAST_COVERAGE) -> list[dict]:
    """The licenses in one text, in order of place."""
    get = index.vocabulary.get
    words = np.array([get(w.lower(), 0) for w in WORD.findall(text)], np.int64)
    hits = index.hits(words)
    if not hits:
        return []
    queue: list[tuple] = []

    def measure(t: int, low: int, high: int, first: int, last: int) -> None:
        """Aligns within words[first:last]."""
        score, matched, begin, end = align(index.words[t], words[first:last], low - first, high - first)
        coverage = matched / len(index.words[t])
        if coverage >= least:
            heapq.heappush(queue, (-score, t, first + begin, low, high, first + end, matched, coverage, first, last))

    for t, low, high in candidates(hits, index):
        measure(t, low, high, max(0, low - BAND), min(len(words), high + BAND + len(index.words[t])))
    kept: list[dict] = []
    while queue:
        score, t, begin, low, high, end, matched, coverage, first, last = heapq.heappop(queue)
        taken = np.flatnonzero(words[first:last] < 0) + first
        if (words[begin:end] < 0).any():
            # A better one has taken words of it: what lies between taken words is measured by itself. These parts hold
            # no taken word, so each measure is of a shorter part and the queue comes to an end.
            need = least * len(index.words[t])
            for a, b in zip([first, *(taken + 1)], [*taken, last]):
                if b - a >= need:
                    measure(t, low, high, a, b)
            continue
        kept.append({"template": t, "license": index.names[t], "matched_words": matched, "coverage": coverage, "begin": begin, "end": end})
        words[begin:end] = -1
    spans = [m.span() for m in WORD.finditer(text)]
    for one in kept:
        one["start_char"], one["end_char"] = spans[one["begin"]][0], spans[one["end"] - 1][1]
    return sorted(kept, key=lambda x: x["begin"])


RESULT = "doc_id long, license string, template int, coverage double, matched_words int, start_char long, end_char long"


def license_scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST_COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per license found: doc_id, license, template (its number), coverage (matched share of the template's
    words), matched_words, start_char and end_char of the span.

    Words are compared in lower case, without punctuation. Texts are scanned whole, however long; null and empty
    ones have no row, and an empty table gives none. A text may hold several licenses, or one several times; spans do
    not overlap: the higher score takes its words, of equal ones the template that comes first, then the place that does.
    Repeated rows are each scanned. A template of one word is never found. Other columns are not read.
    """
    index = Index(templates, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("template", pa.int32()), ("coverage", pa.float64()), ("matched_words", pa.int32()), ("start_char", pa.int64()), ("end_char", pa.int64())])
        for batch in batches:
            rows = [one | {"doc_id": i} for i, text in zip(batch.column(0).to_pylist(), batch.column(1)) for one in scan_text(text.as_py() or "", index, least)]
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, RESULT)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
