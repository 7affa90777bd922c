"""License scans: winnowed fingerprints of templates in an inverted index, then banded alignment.

Templates and documents are sequences of words; each run of ``GRAM`` words has a hash, and winnowing keeps
the least hash of every ``WINNOW`` neighbouring ones, so any shared passage of GRAM + WINNOW - 1 words shares
a kept hash.  The templates' kept hashes form an inverted index (hash to template and place); a
document's kept hashes are looked up there, and every hit proposes a template at an offset.  Around each
cluster of offsets a banded local alignment of words scores the match and gives what share of the
template it covers and where in the document it stands.  The grams of templates too short to be sure of a
shared kept hash are looked up at every place of a document.

The index and the templates are a parameter of bounded size; documents are not shuffled.

Defined results: null, empty and blank texts match nothing; of overlapping matches the best alignment
score, then the best coverage, then the template that sorts first is reported; repeated rows each get theirs; empty
tables give empty results; a template shorter than a gram is matched by no document.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm import textbuf
from stargrain.llm.common import in_arrow, q

GRAM, WINNOW = 3, 2
BAND = 8
LEAST_COVERAGE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1

# Notices of public licenses, as their publishers word them (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                         "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                      "files (the \"Software\"), to deal in the Software without restriction",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                          "following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
    "copyright-all-rights-reserved": "Copyright. All rights reserved.",
}


def grams(hashes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash for each run of ``gram`` words."""
    if len(hashes) < gram:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - gram + 1, np.uint64)
    for i in range(gram):
        out = (out ^ hashes[i:len(hashes) - gram + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def winnow(values: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Places of the least (rightmost of equals) value of each ``window`` neighbours; all of a shorter list count as one window."""
    if not len(values):
        return np.zeros(0, np.int64)
    window = min(window, len(values))
    views = np.lib.stride_tricks.sliding_window_view(values, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))


class Index:
    """Templates as word hashes, and their winnowed grams as a sorted list with template and place."""

    def __init__(self, templates: Mapping[str, str], gram: int = GRAM, window: int = WINNOW):
        self.gram, self.window = gram, window
        self.names = sorted(templates)
        self.words = []
        hashes, owners, places, short = [], [], [], []
        for t, name in enumerate(self.names):
            words, _, _ = words_of(templates[name])
            self.words.append(words)
            g = grams(words, gram)
            kept = winnow(g, window)
            if len(g) < window:
                short.append(g[kept])
            hashes.append(g[kept]), owners.append(np.full(len(kept), t)), places.append(kept)
        order = np.argsort(np.concatenate(hashes), kind="stable") if hashes else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes)[order] if hashes else np.zeros(0, np.uint64)
        self.owners = np.concatenate(owners)[order] if hashes else order
        self.places = np.concatenate(places)[order] if hashes else order
        # kept grams of templates of less than a window: a document's winnowing may leave them out
        self.short = np.unique(np.concatenate(short)) if short else np.zeros(0, np.uint64)

    def hits(self, values: np.ndarray) -> np.ndarray:
        """Which values are in the index."""
        if not len(self.hashes):
            return np.zeros(len(values), bool)
        at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        return self.hashes[at] == values


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends in bytes) of a text's words: digits, ASCII letters lower-cased, bytes of other characters."""
    data = textbuf.LOWER[np.frombuffer(text.encode(), np.uint8)] if text else np.zeros(0, np.uint8)
    starts, ends = textbuf.word_spans(data, np.array([0, len(data)]), textbuf.ALNUM)
    return textbuf.word_hashes(data, starts, ends), starts, ends


def align(template: np.ndarray, words: np.ndarray, offset: int, band: int = BAND) -> tuple[int, int, int, int]:
    """Banded local alignment of a template with words near ``template place + offset``: (score, matched template
    words, first word, end word)."""
    n, m = len(template), len(words)
    width = 2 * band + 1
    score = np.zeros((n + 1, width + 2), np.int64)
    # for each cell: matched words and the first word of its best path
    matched, first = np.zeros_like(score), np.zeros_like(score)
    best = (0, 0, 0, 0)
    for i in range(1, n + 1):
        low = i - 1 + offset - band  # word of band column 1
        for c in range(1, width + 1):
            j = low + c - 1
            if j < 0 or j >= m:
                continue
            same = template[i - 1] == words[j]
            # the cell before both: one row up, same band column
            options = [(score[i - 1, c] + (MATCH if same else MISMATCH), matched[i - 1, c] + int(same), first[i - 1, c] if score[i - 1, c] else j),
                       (score[i - 1, c + 1] + GAP, matched[i - 1, c + 1], first[i - 1, c + 1]),
                       (score[i, c - 1] + GAP, matched[i, c - 1], first[i, c - 1])]
            s, k, f = max(options, key=lambda o: (o[0], o[1]))
            if s > 0:
                score[i, c], matched[i, c], first[i, c] = s, k, f
                if s > best[0]:
                    best = (int(s), int(k), int(f), j + 1)
    return best


def scan_words(hashes: np.ndarray, index: Index, least_coverage: float = LEAST_COVERAGE, band: int = BAND) -> list[tuple[int, float, int, int]]:
    """(template, coverage, first word, end word) of the matches in one document, not overlapping."""
    values = grams(hashes, index.gram)
    kept = winnow(values, index.window)
    kept = kept[index.hits(values[kept])]
    if len(index.short):
        kept = np.union1d(kept, np.flatnonzero(np.isin(values, index.short)))
    proposals: dict[int, list[int]] = {}
    for place in kept.tolist():
        a, b = np.searchsorted(index.hashes, values[place], "left"), np.searchsorted(index.hashes, values[place], "right")
        for t, p in zip(index.owners[a:b].tolist(), index.places[a:b].tolist()):
            proposals.setdefault(t, []).append(place - p)
    matches = []
    for t, offsets in proposals.items():
        offsets = sorted(set(offsets))
        # offsets of one occurrence differ by words added or left out; those of repeated ones by a template's length
        reach = min(band, len(index.words[t]) // 2)
        group = [offsets[0]]
        for o in [*offsets[1:], None]:
            if o is not None and o - group[0] <= reach:
                group.append(o)
                continue
            score, matched, first, end = align(index.words[t], hashes, group[len(group) // 2], max(1, reach))
            coverage = matched / len(index.words[t])
            if coverage >= least_coverage:
                matches.append((score, t, coverage, first, end))
            group = [o]
    # the best first; what overlaps a better one goes
    chosen: list[tuple[int, float, int, int]] = []
    for _, *m in sorted(matches, key=lambda m: (-m[0], -m[2], m[1])):
        if all(m[3] <= c[2] or c[3] <= m[2] for c in chosen):
            chosen.append(tuple(m))
    return sorted(chosen, key=lambda m: m[2])


def _matches(batches: Iterator[pa.RecordBatch], index: Index, least_coverage: float) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "license", "coverage", "start", "end", "words"]
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        data, offsets = textbuf.buffer_of(batch.column(batch.schema.get_field_index("text")))
        data = textbuf.LOWER[data]
        rows, found = [], []
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), side="right")) - 1)
            part, own = data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            starts, ends = textbuf.word_spans(part, own, textbuf.ALNUM)
            hashes = textbuf.word_hashes(part, starts, ends)
            bounds = np.searchsorted(starts, own)
            # texts in which some gram is in the index: only there can a kept one be
            hit = np.flatnonzero(index.hits(grams(hashes, index.gram)))
            for t in np.unique(np.searchsorted(bounds, hit, side="right") - 1).tolist():
                a, b = bounds[t], bounds[t + 1]
                for license_, coverage, x, y in scan_words(hashes[a:b], index, least_coverage):
                    rows.append(at + t)
                    found.append((index.names[license_], coverage, textbuf.code_point_offset(part, own[t], starts[a + x]),
                                  textbuf.code_point_offset(part, own[t], ends[a + y - 1]), y - x))
            at = to
        columns = list(zip(*found)) or [()] * 5
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                                          *(pa.array(c, pa.int64()) for c in columns[2:])], names=names)


def scan(docs: DataFrame, *, templates: Mapping[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text",
         least_coverage: float = LEAST_COVERAGE) -> DataFrame:
    """A row for each match: doc_id, license, coverage (share of the template's words), start and end (code points), words."""
    own = docs.select(F.col(q(doc_id)).alias("doc_id"), F.col(q(text)).alias("text"))
    index = Index(templates)
    kind = own.schema["doc_id"].dataType.simpleString()
    return in_arrow(own, lambda batches: _matches(batches, index, least_coverage),
                          f"doc_id {kind}, license string, coverage double, start bigint, end bigint, words bigint")
