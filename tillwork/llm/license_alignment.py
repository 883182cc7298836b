"""License scans by patience alignment.

Text and template are compared as words. Words that occur once in either side are anchors; the
longest increasing subsequence of their places keeps those in the same order, found by patience
sorting; matches grow from the anchors word by word, and the gaps between them are aligned in the
same way until nothing is unique. A template's coverage is the share of its words that are
aligned. A document has the license whose coverage is at least ``coverage``, over a stretch that
is at most ``stretch`` times as long as the template; of several, the one with most aligned words.
Every stretch of that length that can hold enough of the template's words, and begins with one of
them, is aligned by itself, so that a word is unique in its stretch and not in the whole text.

Scale: one pass without a shuffle. The words of a batch are coded once; only documents that hold
enough of a template's different words are aligned with it, which loses nothing, as coverage needs
them. The list of templates is a parameter and small; it travels with the tasks.

Edge cases: a null or empty text has no license. Repeated rows are scanned one by one. Other
columns are not read. Ties go to the template listed first. Long texts are aligned whole. An
empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillwork.llm.words import ascii_words, filled, slices

FOUND = (
    "doc_id long, license string, coverage double, n_matched long, start long, end long, all_licenses string"
)

# License notices and texts as their publishers word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer.",
    ),
    ("All-rights-reserved", "All rights reserved."),
)

_EDGES = " \t\n\v\f\r.,;:!?()[]{}\"'`*#|<>"
_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @classmethod
    def of(cls, name: str, text: str) -> Template:
        return cls(name, tuple(w for w in (plain(m) for m in text.split()) if w))


def plain(word: str) -> str:
    """A word without case and outer punctuation."""
    return word.strip(_EDGES).lower()


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for index, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(index)
        else:
            tops[pile], piles[pile] = value, index
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def aligned(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs (place in text, place in template) of aligned words, in order."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        if a >= b or c >= d:
            continue
        in_template = Counter(template[c:d])
        in_text = Counter(w for w in text[a:b] if w in in_template)
        place = {template[k]: k for k in range(c, d) if in_template[template[k]] == 1}
        anchors = [
            (k, place[text[k]]) for k in range(a, b) if text[k] in place and in_text[text[k]] == 1
        ]
        chain = [anchors[k] for k in increasing([q for _, q in anchors])]
        if not chain:
            continue
        low_text, low_template = a, c
        for number, (p, q) in enumerate(chain):
            if p < low_text or q < low_template:
                continue
            start, begin = p, q
            while start > low_text and begin > low_template and text[start - 1] == template[begin - 1]:
                start, begin = start - 1, begin - 1
            until_text, until_template = chain[number + 1] if number + 1 < len(chain) else (b, d)
            stop, end = p + 1, q + 1
            while stop < until_text and end < until_template and text[stop] == template[end]:
                stop, end = stop + 1, end + 1
            pairs += zip(range(start, stop), range(begin, end))
            gaps.append((low_text, start, low_template, begin))
            low_text, low_template = stop, end
        gaps.append((low_text, b, low_template, d))
    return sorted(pairs)


def best_stretch(pairs: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """The most pairs whose places in the text lie within ``room`` words."""
    best, low = (0, 0), 0
    for high in range(len(pairs)):
        while pairs[high][0] - pairs[low][0] >= room:
            low += 1
        if high + 1 - low > best[1] - best[0]:
            best = (low, high + 1)
    return pairs[best[0] : best[1]]


def stretches(words: list[str], template: tuple[str, ...], room: int, coverage: float) -> list[tuple[int, int]]:
    """Places of the stretches of ``room`` words that begin with a word of the template and hold
    enough of its words, each counted as often as the template has it."""
    in_template = Counter(template)
    places = [k for k, w in enumerate(words) if w in in_template]
    held: Counter[str] = Counter()
    total, high, out = 0, 0, []
    for low in places:
        while high < len(places) and places[high] < low + room:
            word = words[places[high]]
            held[word] += 1
            total += held[word] <= in_template[word]
            high += 1
        if total >= coverage * len(template):
            out.append((low, min(low + room, len(words))))
        total -= held[words[low]] <= in_template[words[low]]
        held[words[low]] -= 1
    return out


def best_alignment(words: list[str], template: tuple[str, ...], room: int, coverage: float) -> list[tuple[int, int]]:
    """The most aligned pairs of the text as a whole or of one stretch; of equal ones the first."""
    best = best_stretch(aligned(words, list(template)), room)
    for low, high in stretches(words, template, room, coverage):
        if len(best) == len(template):
            break
        pairs = aligned(words[low:high], list(template))
        if len(pairs) > len(best):
            best = [(p + low, q) for p, q in pairs]
    return best


def found_in(
    text: str, templates: list[Template], coverage: float, stretch: float
) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, aligned words, start, end) of every license in a text."""
    spots = [(plain(m.group()), m.start(), m.end()) for m in _SPLIT.finditer(text)]
    spots = [s for s in spots if s[0]]
    words = [s[0] for s in spots]
    out = []
    for template in templates:
        size = len(template.words)
        pairs = best_alignment(words, template.words, max(size, int(size * stretch)), coverage)
        if len(pairs) >= coverage * size:
            start, end = spots[pairs[0][0]][1], spots[pairs[-1][0]][2]
            out.append((template.name, len(pairs) / size, len(pairs), start, end))
    return out


def _scanner(templates: list[Template], coverage: float, stretch: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = filled(part.column("text"))
                counts, words, codes = ascii_words(texts)
                owner = np.repeat(np.arange(len(counts)), counts)
                stems = pc.utf8_lower(pc.utf8_trim(words, _EDGES))
                wanted = [[] for _ in range(part.num_rows)]
                for template in templates:
                    terms = sorted(set(template.words))
                    term = pc.fill_null(pc.index_in(stems, pa.array(terms)), -1).to_numpy(zero_copy_only=False)
                    hits = term[codes]
                    spots = np.flatnonzero(hits >= 0)
                    held = np.unique(owner[spots] * len(terms) + hits[spots]) // len(terms)
                    # Aligned words are at most size - (terms that are missing).
                    enough = coverage * len(template.words) - (len(template.words) - len(terms))
                    for row in np.flatnonzero(np.bincount(held, minlength=part.num_rows) >= max(enough, 1)):
                        wanted[row].append(template)
                out = [[None] * part.num_rows for _ in range(6)]
                for row, near in enumerate(wanted):
                    found = found_in(texts[row].as_py(), near, coverage, stretch) if near else []
                    if found:
                        top = max(found, key=lambda f: f[2])
                        for column, value in zip(out, (*top, ",".join(f[0] for f in found))):
                            column[row] = value
                    else:
                        out[1][row], out[2][row], out[5][row] = 0.0, 0, ""
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                    names=["doc_id", "license", "coverage", "n_matched", "start", "end", "all_licenses"],
                )

    return rows


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    coverage: float = 0.8,
    stretch: float = 1.5,
) -> DataFrame:
    """One row per row of ``docs``: the best license or null, its coverage, aligned words and
    span (code points, end exclusive), and all licenses found, comma-joined."""
    cut = [Template.of(name, text) for name, text in templates]
    return docs.select("doc_id", "text").mapInArrow(_scanner(cut, coverage, stretch), FOUND)
