"""License scans (operator 9): texts against licence templates by Dice coefficient.

A text's units are its lines, the whole text and windows of words wherever they
begin and end, which find a notice wrapped over lines or standing within other
prose. A unit is normalised to lower case letters and digits, and its set of
word pairs is compared with each template's: twice the shared pairs over the
pairs of both. A unit of ``a`` pairs
can reach ``t`` with a template of ``b`` pairs only if ``a`` lies between ``b * t /
(2 - t)`` and ``b * (2 - t) / t``, so the templates are sorted by size and a
unit meets only those within its limits. The best window of a template begins
and ends with a pair of the template, and its first pair does not come again in
it; all such windows are looked at, and only in texts that hold enough of a
template's pairs. A null text has no match.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.llm.license_texts import WHOLE_TEXTS

#: Public licence notices and short licence texts by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    *WHOLE_TEXTS,
]
WORD = re.compile(r"[^\W_]+")

Pairs = frozenset[tuple[str, str]]


def pairs(text: str) -> Pairs:
    words = WORD.findall(text.lower())
    return frozenset(zip(words, words[1:], strict=False))


class Templates:
    """Templates in order of size, and the pairs that occur in any of them."""

    def __init__(self, templates: list[tuple[str, str]], least: float):
        self.least = least
        self.rows = sorted(((len(p), name, number, p) for number, (name, text) in enumerate(templates) if (p := pairs(text))), key=lambda r: r[:3])
        self.sizes = [r[0] for r in self.rows]
        self.words = frozenset(w for r in self.rows for p in r[3] for w in p)
        self.smallest = self.bounds(self.sizes[0])[0] if self.sizes else 0
        self.largest = self.bounds(self.sizes[-1])[1] if self.sizes else -1
        self.index: dict[tuple[str, str], list[int]] = defaultdict(list)
        for place, row in enumerate(self.rows):
            for p in row[3]:
                self.index[p].append(place)
        self.index = dict(self.index)
        # rounding must not ask for one shared pair too many
        self.need = [max(1, math.ceil(self.bounds(size)[0] - 1e-9)) for size in self.sizes]

    def held(self, words: list[str]) -> list[int]:
        """Templates of which ``words`` hold as many distinct pairs as any match shares."""
        counts: dict[int, int] = defaultdict(int)
        for p in self.index.keys() & set(zip(words, words[1:], strict=False)):
            for place in self.index[p]:
                counts[place] += 1
        return [place for place, n in counts.items() if n >= self.need[place]]

    def bounds(self, size: int) -> tuple[float, float]:
        return size * self.least / (2 - self.least), size * (2 - self.least) / self.least

    def best(self, unit: Pairs) -> tuple[float, str, int] | None:
        """The highest coefficient with its licence and template; ties go to the first template in the list."""
        low, high = self.bounds(len(unit))
        found = None
        for size, name, number, p in self.rows[bisect_left(self.sizes, low) : bisect_right(self.sizes, high)]:
            shared = len(unit & p)
            score = 2 * shared / (len(unit) + size)
            if score >= self.least and (found is None or (-score, number) < (-found[0], found[2])):
                found = score, name, number
        return found


def matches(text: str, templates: Templates) -> list[tuple[int, int, str, float]]:
    """``(start, end, licence, score)`` of matching units by place, the whole text last if it matches as such."""
    out, at = [], 0
    lines = text.split("\n")
    # a unit of n pairs has more than n words, and every word needs two characters
    for line in lines:
        if len(line) >= 2 * templates.smallest:
            found = _match(line, templates)
            if found:
                out.append((at, at + len(line), found[1], found[0]))
        at += len(line) + 1
    if len(lines) > 1:
        found = _match(text, templates)
        if found:
            out.append((0, len(text), found[1], found[0]))
    return out


def windows(text: str, templates: Templates, held: list[int]) -> list[tuple[int, int, str, float]]:
    """``(start, end, licence, score)`` of the best windows of the ``held`` templates by place; none overlap.

    Of overlapping windows of one licence the one that holds the other counts,
    else the higher score; ties go to the first template in the list.
    """
    tokens = [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    last: dict[tuple[str, str], int] = {}
    n = max(0, len(tokens) - 1)
    before, after = np.full(n, -1), np.full(n, n)
    hits: dict[int, list[int]] = {place: [] for place in held}
    for i in range(n):
        pair = tokens[i][0], tokens[i + 1][0]
        if pair in last:
            before[i] = last[pair]
            after[last[pair]] = i
        last[pair] = i
        for place in templates.index.get(pair, ()):
            if place in hits:
                hits[place].append(i)
    found = []
    for place, at in hits.items():
        size, name, number, _ = templates.rows[place]
        found += [(a, b, name, score, number) for a, b, score in _windows(np.array(at), before, after, size, templates)]
    inner = _inside(found)
    taken, out = np.zeros(n, bool), []
    for a, b, name, score, _ in sorted((w for w, i in zip(found, inner, strict=True) if not i), key=lambda w: (-w[3], w[0] - w[1], w[4], w[0])):
        if not taken[a : b + 1].any():
            taken[a : b + 1] = True
            out.append((tokens[a][1], tokens[b + 1][2], name, score))
    return sorted(out)


def _inside(found: list[tuple[int, int, str, float, int]]) -> list[bool]:
    """Whether each window lies within a longer one of its licence."""
    out, far = [False] * len(found), {}
    for i in sorted(range(len(found)), key=lambda i: (found[i][0], -found[i][1])):
        a, b, name = found[i][:3]
        start, end = far.get(name, (-1, -1))
        out[i] = b <= end and (a, b) != (start, end)
        if b > end:
            far[name] = a, b
    return out


def _windows(at: np.ndarray, before: np.ndarray, after: np.ndarray, size: int, templates: Templates) -> list[tuple[int, int, float]]:
    """``(first, last, score)``: the best windows of one template, by pairs; ``at`` are the places of its pairs."""
    mine = np.zeros(len(before), bool)
    mine[at] = True
    high = templates.bounds(size)[1]
    best = []
    for i in at:
        stop, width = min(after[i], at[-1] + 1), 2 * int(high) + 16
        while True:
            end = min(stop, i + width)
            fresh = before[i:end] < i
            distinct = np.cumsum(fresh)
            if end == stop or distinct[-1] > high:
                break
            width *= 2
        shared = np.cumsum(fresh & mine[i:end])
        scores = 2 * shared / (distinct + size)
        if scores.max() >= templates.least:
            # pairs that come again change no score; the last that reaches the best one ends the window
            j = int(np.flatnonzero((scores == scores.max()) & mine[i:end])[-1])
            best.append((float(scores[j]), int(i), int(i) + j))
    taken, out = np.zeros(len(before), bool), []
    for score, a, b in sorted(best, key=lambda w: (-w[0], w[1])):
        if not taken[a : b + 1].any():
            # nor do pairs before the window that come again in it
            while a > 0 and mine[a - 1] and after[a - 1] <= b and not taken[a - 1]:
                a -= 1
            taken[a : b + 1] = True
            out.append((a, b, score))
    return out


def found_in(text: str, templates: Templates) -> list[tuple[int, int, str, float]]:
    """Matches of lines and the whole text, then of windows unless one of them overlaps with the same licence or a score as high."""
    held = templates.held(WORD.findall(text.lower()))
    if not held:
        return []
    units = matches(text, templates)
    more = [w for w in windows(text, templates, held) if not any(a < w[1] and w[0] < b and (name == w[2] or score >= w[3]) for a, b, name, score in units)]
    return sorted(units + more, key=lambda m: (m[:2] == (0, len(text)), m[:2]))


def _match(unit: str, templates: Templates) -> tuple[float, str, int] | None:
    # words that no template has make only pairs that none has; shared pairs are then too few
    words = WORD.findall(unit.lower())
    if len(words) < 2 or len(templates.words.intersection(words)) < 2:
        return None
    unit_pairs = frozenset(zip(words, words[1:], strict=False))
    return templates.best(unit_pairs) if templates.smallest <= len(unit_pairs) <= templates.largest else None


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """``(id, n_matches, license, score, spans)`` for each row: its matching units and windows and the best of them.

    ``spans`` lists ``licence:start:end`` in code points by place. Ties go to
    the first unit. Rows without a match have a null licence and score 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, least)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                found = found_in(value.as_py() or "", known)
                top = max(found, key=lambda m: m[3], default=(0, 0, None, 0.0))
                rows.append((len(found), top[2], top[3], ",".join(f"{m[2]}:{m[0]}:{m[1]}" for m in found)))
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=["id", "n_matches", "license", "score", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_matches long, license string, score double, spans string")
