"""Operator 10: license scans by MinHash bands over overlapping text windows.

Template notices are matched inside longer texts. Words are compared in lower case without punctuation at their ends,
as shingles of five words. A template belongs to the class of windows (1, 2, 4, 8, ... shingles) about twice its
length; windows of a class overlap by half, so one of them holds a whole copy.

* Retrieval: a window and a template are candidates if one of their MinHash values agrees (bands of one row). A
  class has as many bands as make a miss rarer than ``MISS`` at the least Jaccard similarity that a window around a
  matching copy can have, so retrieval is certain up to that probability, exactly certain where copies fill the window.
* Verification: the share of the template's distinct shingles that lie in the candidate window; a match needs
  ``CONTAINMENT``. Matching windows of a template that overlap are merged, and each copy in them is returned with the
  words it spans: a text that holds a notice several times has a row for each.

Window minima are built from halves, so a class costs one pass over its minima. Templates are a parameter of at most
``MAX_TEMPLATES``, which every task holds; texts are read whole by one scan without a shuffle.

Null, empty and short texts (under five words) match nothing, as do templates under five words, which are refused.
Repeated rows and null ids are rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import SHINGLE_WORDS, WordHash, mix, rows_of, shingle_hashes, utf8

MAX_TEMPLATES = 5000
CONTAINMENT = 0.8
MISS = 1e-4
#: Hashes (bands times shingles) that are held at once; longer texts take fewer bands at a time.
MATRIX = 1 << 20
FOUND = "doc_id long, template string, start int, stop int, containment double"

#: Standard wordings of license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."),
    "BSD-clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
    "BSD-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}

_ENDS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_STEP = np.uint64(0x9E3779B97F4A7C15)


class LicenseWords(WordHash):
    """Hash of a word without punctuation at its ends; 0 for a word of nothing else."""

    def __missing__(self, word: bytes) -> int:
        core = word.strip(_ENDS)
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = (self.digest(core) | 1) if core else 0
        return h


def document_shingles(text: bytes, hashes: LicenseWords):
    """Shingle hashes in order, and the word place of each word that counts."""
    words = hashes.of(text.lower().split())
    place = np.flatnonzero(words)
    words = words[place]
    return (shingle_hashes(words) if len(words) >= SHINGLE_WORDS else words[:0]), place


def minhash(shingles: np.ndarray, low: int, high: int) -> np.ndarray:
    """Hashes of the shingles, a row per band: a row's minimum over a set is the set's MinHash in that band."""
    h = (shingles[None, :] ^ mix(np.arange(low + 1, high + 1, dtype=np.uint64) * _STEP)[:, None]) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def window_class(shingles: int) -> int:
    """Shingles in the windows a template of so many shingles is looked for in: a power of two whose overlapping
    windows hold a whole copy wherever it begins."""
    size = 1
    while shingles > size - size // 2 + (1 if size > 1 else 0):
        size *= 2
    return size


def bands_for(shingles: int, size: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Bands that retrieve a matching window but for a probability below ``miss``."""
    shared = math.ceil(containment * shingles - 1e-9)
    jaccard = shared / (size + shingles - shared)
    return 1 if jaccard >= 1 else math.ceil(math.log(miss) / math.log1p(-jaccard))


def copies(at: list[int], found: list[int], rank: dict[int, int], distinct: int, size: int, containment: float) -> list[tuple[int, int, int]]:
    """Disjoint copies of a template among its shingles in a text: first and last place, distinct shingles.

    ``at`` and ``found``: places and hashes of the shingles that the template has; ``rank``: their places in the template.
    A copy's core is the earliest run, of at most ``size`` places, that holds enough distinct shingles, and what follows
    it in the template's order. What lies between two cores is dealt to both where they gain most, and a copy ends where
    it gains nothing more."""
    cores, low, counts = [], 0, Counter()
    for i, x in enumerate(found):
        if i < low:
            continue
        counts[x] += 1
        while counts[found[low]] > 1 or at[i] - at[low] >= size:  # no shorter run holds as many
            counts[found[low]] -= 1
            if not counts[found[low]]:
                del counts[found[low]]
            low += 1
        if len(counts) / distinct >= containment:
            end = i
            while end + 1 < len(found) and rank[found[end + 1]] > rank[found[end]] and found[end + 1] not in counts and at[end + 1] - at[low] < size:
                end += 1
                counts[found[end]] += 1
            cores.append((low, end))
            low, counts = end + 1, Counter()

    def gains(core, side):
        """Hits of ``side``, in order from the core, that are new to it, as places in ``side``."""
        have, out = set(found[core[0] : core[1] + 1]), []
        for k, j in enumerate(side):
            if abs(at[j] - at[core[0] if j < core[0] else core[1]]) >= size:
                break
            if found[j] not in have:
                have.add(found[j])
                out.append(k + 1)
        return out

    spans = [list(c) for c in cores]
    for c in range(len(cores) + 1):
        first = cores[c - 1][1] + 1 if c else 0
        last = cores[c][0] if c < len(cores) else len(found)
        after = gains(cores[c - 1], range(first, last)) if c else []
        before = gains(cores[c], range(last - 1, first - 1, -1)) if c < len(cores) else []
        best = max([0, *after], key=lambda k: (bisect_right(after, k) + bisect_right(before, last - first - k), -k))
        if c:
            spans[c - 1][1] = first + best - 1
        if c < len(cores):
            reach = bisect_right(before, last - first - best)
            spans[c][0] = last - before[reach - 1] if reach else last
    return [(at[i], at[j], len(set(found[i : j + 1]))) for i, j in spans]


class Templates:
    """Shingle sets of the templates and, per window class and band, the MinHash values to look for."""

    def __init__(self, texts: dict[str, str], containment: float = CONTAINMENT, miss: float = MISS):
        if len(texts) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        hashes, self.containment = LicenseWords(), containment
        self.names, self.sets, self.ranks, by_class = list(texts), [], [], {}
        for i, name in enumerate(self.names):
            s, first = np.unique(document_shingles(texts[name].encode(), hashes)[0], return_index=True)
            if not len(s):
                raise ValueError(f"template {name} has fewer than {SHINGLE_WORDS} words")
            self.sets.append(s)
            self.ranks.append(dict(zip(s.tolist(), first.tolist())))
            size = window_class(len(s))
            by_class.setdefault(size, []).append((i, bands_for(len(s), size, containment, miss)))
        #: class size -> bands, sorted MinHash values to look for, and the template of each
        self.classes = {}
        for size, members in sorted(by_class.items()):
            pairs = sorted((int(v), i) for i, n in members for v in minhash(self.sets[i], 0, n).min(1))
            self.classes[size] = (max(n for _, n in members), np.array([v for v, _ in pairs], np.uint64), np.array([i for _, i in pairs]))
        self.most = max((n for n, _, _ in self.classes.values()), default=0)

    def candidates(self, shingles: np.ndarray) -> list[tuple[int, int, int]]:
        """(class size, first shingle of the window, template) that share a MinHash value, each once."""
        out, rows = set(), max(1, MATRIX // max(1, len(shingles)))
        for low in range(0, self.most if len(shingles) else 0, rows):
            high = min(self.most, low + rows)
            step, m = 1, minhash(shingles, low, high)
            for size, (bands, values, which) in self.classes.items():
                half = max(1, size // 2)
                while step < half:  # minima of blocks of `step` shingles to blocks of twice as many
                    if m.shape[1] % 2:
                        m = np.hstack([m, m[:, -1:]])
                    m = np.minimum(m[:, ::2], m[:, 1::2])
                    step *= 2
                w = m[: max(0, bands - low)]
                if not len(w):
                    continue
                if size > 1:
                    w = np.minimum(w, np.hstack([w[:, 1:], w[:, -1:]]))
                at = np.searchsorted(values, w)
                for band, p in zip(*np.nonzero(values[np.minimum(at, len(values) - 1)] == w)):
                    j = at[band, p]
                    while j < len(values) and values[j] == w[band, p]:
                        out.add((size, int(p) * half, int(which[j])))
                        j += 1
        return sorted(out)

    def scan(self, text: bytes, hashes: LicenseWords):
        """Copies of each template in a text: (name, first word, word after the last, containment)."""
        shingles, place = document_shingles(text, hashes)
        areas = {}
        for size, at, t in self.candidates(shingles) if len(shingles) else []:
            cut = shingles[at : at + size]
            if len(np.intersect1d(cut, self.sets[t])) / len(self.sets[t]) >= self.containment:
                mine = areas.setdefault(t, [])
                if mine and at <= mine[-1][1]:
                    mine[-1][1] = at + size
                else:
                    mine.append([at, at + size, size])
        out = []
        for t, mine in sorted(areas.items()):
            for low, high, size in mine:
                inside = low + np.flatnonzero(np.isin(shingles[low:high], self.sets[t]))
                for a, b, n in copies(inside.tolist(), shingles[inside].tolist(), self.ranks[t], len(self.sets[t]), size, self.containment):
                    out.append((self.names[t], int(place[a]), int(place[b + SHINGLE_WORDS - 1]) + 1, n / len(self.sets[t])))
        return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, template, start and stop (words of the text, white space apart) and containment of each match."""
    Templates(templates, containment)  # bad templates fail here
    texts = dict(templates)

    def run(batches):
        import pyarrow as pa

        known, hashes = Templates(texts, containment), LicenseWords()
        for b in batches:
            found = [(d, *m) for d, t in rows_of(b, "doc_id", "text") for m in known.scan(t, hashes)]
            columns = list(zip(*found)) if found else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "template", "start", "stop", "containment"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).mapInArrow(run, FOUND)
