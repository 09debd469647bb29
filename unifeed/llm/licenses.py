"""Operator 7: license scans by patience alignment.

A document that has words enough of a template is looked through for its word pairs; where
they agree on where a copy would start, a window of bounded length around that copy is
aligned with the template: words that occur once in the window and once in the template are
anchors, their longest increasing subsequence is kept, and the gaps between anchors are
aligned the same way (common ends first).  Coverage is the share of a template's words found
in order; every copy is told.  Everything runs inside the scan of the documents; templates
are a bounded parameter.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as wd

MIN_COVERAGE = 0.8
MARGIN = 8          # words looked at beyond the first and last sign of a template
_BREAK = np.ones(256, dtype=bool)            # bytes that part words: ASCII but letters and digits
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

# Short notices and permission texts of common licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit-notice": "Released under the MIT License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "all-rights-reserved": "All rights reserved",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
}

_GNU = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as "
        "published by the Free Software Foundation; either version {} of the License, or (at your option) any later "
        "version.")
_CC = "This work is licensed under a Creative Commons {} International License"

# More notices; a license may have several templates, its whole text among them (``license_texts``).
NOTICES = [
    ("gpl-2.0-header", _GNU.format("program", "General Public License", "2")),
    ("lgpl-2.0-header", _GNU.format("library", "Library General Public License", "2")),
    ("lgpl-2.1-header", _GNU.format("library", "Lesser General Public License", "2.1")),
    ("lgpl-3.0-header", _GNU.format("program", "Lesser General Public License", "3")),
    ("agpl-3.0-header", _GNU.format("program", "Affero General Public License", "3")),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                       "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl-1.0-header", "This program and the accompanying materials are made available under the terms of the Eclipse "
                       "Public License v1.0 which accompanies this distribution, and is available at "
                       "http://www.eclipse.org/legal/epl-v10.html"),
    ("epl-2.0-header", "This program and the accompanying materials are made available under the terms of the Eclipse "
                       "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("cc-by-4.0", _CC.format("Attribution 4.0")),
    ("cc-by-sa-4.0", _CC.format("Attribution-ShareAlike 4.0")),
    ("cc-by-nd-4.0", _CC.format("Attribution-NoDerivatives 4.0")),
    ("cc-by-nc-4.0", _CC.format("Attribution-NonCommercial 4.0")),
    ("cc-by-nc-sa-4.0", _CC.format("Attribution-NonCommercial-ShareAlike 4.0")),
    ("cc-by-nc-nd-4.0", _CC.format("Attribution-NonCommercial-NoDerivatives 4.0")),
]


def covered() -> list[tuple[str, str]]:
    """(license, template) of all notices and whole texts that a scan knows unless told others;
    read on the driver."""
    whole = sorted((f for f in files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")),
                   key=lambda f: f.name)
    return [*TEMPLATES.items(), *NOTICES, *((f.name[:-4], f.read_text("utf-8")) for f in whole)]


def _split(column: pa.Array):
    """(row, word hashes) of every text."""
    for lo, hi, data, offsets in wd.chunks(column):
        data = np.where(_BREAK[data], np.uint8(32), data)
        start, end, row = wd.split(data, offsets)
        yield lo, hi, wd.word_hashes(data, start, end), row


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of (a, b), sorted by a, whose b increase (patience sorting)."""
    tops, piles, back = [], [], []
    for n, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        if at == len(tops):
            tops.append(b)
            piles.append(n)
        else:
            tops[at], piles[at] = b, n
        back.append(piles[at - 1] if at else -1)
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of the template ``a`` and the text ``b`` by patience alignment."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        where, once = {}, {}
        for i in range(a0, a1):
            where[a[i]] = -1 if a[i] in where else i
        for j in range(b0, b1):
            if where.get(b[j], -1) >= 0:
                once[b[j]] = -1 if b[j] in once else j
        anchors = _increasing(sorted((where[w], j) for w, j in once.items() if j >= 0))
        if not anchors:
            continue
        at, bt = a0, b0
        for i, j in anchors:
            out.append((i, j))
            todo.append((at, i, bt, j))
            at, bt = i + 1, j + 1
        todo.append((at, a1, bt, b1))
    return sorted(out)


class Templates:
    """Word hashes of the templates, where their word pairs stand, and which words they need."""

    def __init__(self, templates: list[tuple[str, str]]):
        templates = sorted(templates)
        self.names = [n for n, _ in templates]
        self.words = [np.concatenate([np.zeros(0, np.uint64)] + [h for _, _, h, _ in _split(pa.array([x]))])
                      for _, x in templates]
        self.lists = [w.tolist() for w in self.words]
        self.signs = []                                  # per template: sorted pair hashes, their places
        for w in self.words:
            h, _, at = wd.windows(w, np.zeros(len(w), dtype=np.int64), 2)
            order = np.argsort(h, kind="stable")
            self.signs.append((h[order], at[order]))
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.uint64)] + [h for h, _ in self.signs]))
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64)] + self.words))
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.uses = np.zeros((len(self.vocabulary), len(self.words)), dtype=np.int32)
        for t, w in enumerate(self.words):
            np.add.at(self.uses[:, t], np.searchsorted(self.vocabulary, w), 1)

    def possible(self, words: np.ndarray, min_coverage: float) -> list[int]:
        """The templates of which a text has words enough, in any order, to cover them."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        has = np.unique(at[self.vocabulary[at] == words])
        most = np.minimum(self.uses[has].sum(axis=0), len(words))
        return np.flatnonzero((most >= min_coverage * self.sizes) & (self.sizes > 1)).tolist()


def _places(words: np.ndarray, at: np.ndarray, start: np.ndarray, own: np.ndarray, known: list[int],
            min_coverage: float) -> list[tuple[int, int, int]]:
    """(words in place, first word, word after last) of every copy of one template; ``at`` are
    the places of its signs in the text, ``start`` where copies that hold them would begin.

    Each start with signs enough is aligned in its own window of bounded length, those with
    most signs first; no place reaches into another.  What is left of a region of signs is
    aligned as a whole, so a copy too torn for any one start is met too."""
    size, least = len(known), min_coverage * len(known)
    band = size // 8
    slacks = (0, max(2, band), max(MARGIN, size // 4), max(MARGIN, size // 2))
    first, after, found = [], [], []

    def free(middle: int) -> tuple[int, int]:
        """The range around a word that no place has; empty if one has the word."""
        k = bisect_right(first, middle)
        lo, hi = after[k - 1] if k else 0, first[k] if k < len(first) else len(words)
        return (lo, hi) if lo <= middle else (lo, lo)

    def aligned(lo: int, hi: int) -> tuple[int, int, int] | None:
        if hi - lo < least or np.isin(own, words[lo:hi]).sum() < least:
            return None
        matched = align(known, words[lo:hi].tolist())
        return (len(matched), lo + matched[0][1], lo + matched[-1][1] + 1) if len(matched) >= max(1, least) else None

    def take(place: tuple[int, int, int]) -> None:
        k = bisect_left(first, place[1])
        first.insert(k, place[1])
        after.insert(k, place[2])
        found.append(place)

    begin, votes = np.unique(start, return_counts=True)
    total = np.append(0, np.cumsum(votes))
    near = total[np.searchsorted(begin, begin + band, "right")] - total[np.searchsorted(begin, begin - band, "left")]
    enough = np.flatnonzero(near >= max(1, (size - 1) / 4))
    failed = set()
    for k in enough[np.lexsort((begin[enough], -near[enough], -votes[enough]))].tolist():
        d = int(begin[k])
        lo, hi = free(max(0, min(len(words) - 1, d + size // 2)))
        step = d // max(1, size // 16)
        if hi - lo < least or step in failed:
            continue
        best = None
        for slack in slacks:
            place = aligned(max(lo, d - slack), min(hi, d + size + slack))
            if place and (best is None or place[0] ** 2 * (best[2] - best[1]) > best[0] ** 2 * (place[2] - place[1])):
                best = place
            if best and best[0] == size == best[2] - best[1]:
                break
        if best:
            take(best)
        else:
            failed.add(step)
    lo = at[0]
    for x, y in zip(at, at[1:] + [None]):
        if y is not None and y - x <= size + MARGIN:
            continue
        s, e = max(0, lo - size - MARGIN), min(len(words), x + size + MARGIN)
        lo = y
        k = bisect_right(after, s)
        taken = list(zip(first[k:bisect_left(first, e)], after[k:]))
        for a, b in zip([s] + [z for _, z in taken], [z for z, _ in taken] + [e]):
            if bisect_left(at, b - 1) - bisect_left(at, a) >= min(2, size - 1):
                place = aligned(a, b)
                if place:
                    take(place)
    return found


def _scan_text(words: np.ndarray, places: np.ndarray, pairs: np.ndarray, known: Templates,
               min_coverage: float):
    """(template, coverage, first word, word after last) of every place where a text carries a
    template; of templates found at overlapping places the one with most words in place is
    told, and of those the best covered."""
    out = []
    for t in known.possible(words, min_coverage):
        hashes, spots = known.signs[t]
        lo, hi = np.searchsorted(hashes, pairs, "left"), np.searchsorted(hashes, pairs, "right")
        count = hi - lo
        at = places[count > 0]
        if len(at) < min(2, len(hashes)):
            continue
        each = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(places, count) - spots[each]
        for n, s, e in _places(words, at.tolist(), start, known.words[t], known.lists[t], min_coverage):
            out.append((t, n / len(known.lists[t]), s, e, n * n / (e - s)))
    out.sort(key=lambda x: (-x[4], -x[1], x[0], x[2]))
    first, kept = [], []
    for x in out:
        k = bisect_left(first, (x[2],))
        if (k == 0 or first[k - 1][1] <= x[2]) and (k == len(first) or x[3] <= first[k][0]):
            first.insert(k, (x[2], x[3]))
            kept.append(x[:4])
    return sorted(kept)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, start_word, end_word): one row per document row and place
    that covers a template to ``min_coverage`` or more, and one with null license for a
    document without any.

    Null and empty texts have no license.  Repeated rows give repeated answers.  An empty table
    gives an empty result; other columns are ignored."""
    known = Templates(covered() if templates is None else list(templates.items()))
    kind = docs.schema[id_col].dataType.simpleString()
    send = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        known = send.value
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(known.pairs >> np.uint64(44)).astype(np.int64)] = True
        for b in batches:
            row, lic, cov, start, end = [], [], [], [], []
            for lo, hi, h, r in _split(b.column(1)):
                pair, of, at = wd.windows(h, r, 2)
                near = bits[(pair >> np.uint64(44)).astype(np.int64)]
                pair, of, at = pair[near], of[near], at[near]
                if len(known.pairs):
                    real = known.pairs[np.minimum(np.searchsorted(known.pairs, pair), len(known.pairs) - 1)] == pair
                    pair, of, at = pair[real], of[real], at[real]
                cut, first = np.searchsorted(of, np.arange(hi - lo + 1)), np.searchsorted(r, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    found = []
                    if cut[i] < cut[i + 1]:
                        found = _scan_text(h[first[i]:first[i + 1]], at[cut[i]:cut[i + 1]] - first[i],
                                           pair[cut[i]:cut[i + 1]], known, min_coverage)
                    for t, c, s, e in found or [(None, 0.0, None, None)]:
                        row.append(lo + i)
                        lic.append(None if t is None else known.names[t])
                        cov.append(c)
                        start.append(s)
                        end.append(e)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(row, pa.int64())), pa.array(lic, pa.string()), pa.array(cov, pa.float64()),
                pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                names=["doc_id", "license", "coverage", "start_word", "end_word"])
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, license string, coverage double, start_word long, end_word long")
