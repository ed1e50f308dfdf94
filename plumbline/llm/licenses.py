"""License scans by patience alignment.

A text and a template are compared word by word, without case and outer
punctuation.  Words that occur once in both are anchors; the longest increasing
run of anchors (by patience sorting) is kept, and the gaps between them are
aligned in the same way, after equal words at a gap's ends.  Coverage is the
share of the template's words that got a partner.

A long text has few unique words, so alignment runs on regions: a template's
``GRAM``-word windows (two words for templates under ``SHORT`` words) are looked up in the text by hash, hits of one template
that lie within its length are one region, and the region is widened by a
quarter of that length.  Every region is aligned, however many a text has, and
no text is cut.  A template counts as found from coverage ``LEAST``.  Where found
regions of several templates overlap, as those of a licence and of a
longer one that begins alike, the one with the most matched words stays.

Templates go to every task; they are a fixed list, ``MOST_WORDS`` words at most.
Nothing is shuffled.  Null and empty texts have no license.  Repeated rows are scanned
one by one, ids may be null.  An empty table gives no rows; only id and text are
read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm._shared import text_of
from plumbline.llm._words import chunks, runs
from plumbline.llm.decontamination import Templates

GRAM, SHORT, LEAST, MOST_WORDS = 3, 10, 0.8, 200_000
_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_FREE = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
# fixed values: licence texts, the headers of those too long to stand in a file, and notices by which texts name their licence
NOTICES: dict[str, str] = {
    "AGPL-3.0-header": _FREE.format("program", "Affero"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": f"{_BSD} {_BSD_END}",
    "BSD-3-Clause": f"{_BSD} {_BSD_NAMES} {_BSD_END}",
    "BSD-grant": _BSD.split(" 1. ")[0],
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": _FREE.format("program", "").replace("  ", " "),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-3.0-header": _FREE.format("library", "Lesser"),
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-text": f"Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "all-rights-reserved": "All rights reserved.",
}


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of equal words of a and b, both in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i >= m or j >= n:
            continue
        once_a, once_b = Counter(a[i:m]), Counter(b[j:n])
        place = {w: k for k, w in enumerate(b[j:n], j) if once_b[w] == 1}
        both = [(k, place[w]) for k, w in enumerate(a[i:m], i) if once_a[w] == 1 and w in place]
        anchors = [both[k] for k in increasing([y for _, y in both])]
        if not anchors:
            continue
        out += anchors
        x, y = i, j
        for p, q in [*anchors, (m, n)]:
            todo.append((x, p, y, q))
            x, y = p + 1, q + 1
    return sorted(out)


class Notices:
    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        t = Templates([templates[n].encode() for n in self.names])
        first = t.words.first
        self.words = [t.plain[first[i] : first[i + 1]].tolist() for i in range(len(self.names))]
        self.grams: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for k in (GRAM, 2):
            at, h = runs(t.plain, t.of, k)
            own = (t.words.n[t.of[at]] < SHORT) == (k == 2)
            at, h = at[own], h[own]
            order = np.argsort(h, kind="stable")
            self.grams.append((k, h[order], t.of[at][order], (at - first[t.of[at]])[order]))

    def scan(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, template, regions found, matched words, first word, last word) of the best region."""
        d = Templates(texts)
        hits: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, known, names, place in self.grams:
            at, h = runs(d.plain, d.of, k)
            lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            for x in np.flatnonzero(hi > lo):
                for y in range(int(lo[x]), int(hi[x])):
                    hits[int(d.of[at[x]])][int(names[y])].append((int(at[x]), int(place[y])))
        for text, own in hits.items():
            begin = int(d.words.first[text])
            regions = [(len(pairs), name, pairs[0][0], pairs[-1][0]) for name, places in own.items() for pairs in self._regions(d, text, name, places)]
            kept: dict[int, list[tuple[int, int, int]]] = {}
            taken: list[tuple[int, int]] = []
            for matched, name, x, y in sorted(regions, key=lambda r: (-r[0], -r[0] / len(self.words[r[1]]), r)):
                # regions that stay are apart, so only the neighbours can overlap
                k = bisect_left(taken, (x, y))
                if (k < len(taken) and taken[k][0] <= y) or (k and taken[k - 1][1] >= x):
                    continue
                taken.insert(k, (x, y))
                kept.setdefault(name, []).append((matched, x - begin, y - begin))
            for name, found in kept.items():
                yield (text, name, len(found), *max(found, key=lambda r: (r[0], -r[1])))

    def _regions(self, d: Templates, text: int, name: int, places: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
        """Pairs of words of each region that is covered enough."""
        template = self.words[name]
        size, begin, end = len(template), int(d.words.first[text]), int(d.words.first[text + 1])
        slack, done = size // 4 + 1, 0
        regions: list[list[tuple[int, int]]] = []
        for p in places:
            if regions and p[0] - regions[-1][-1][0] <= size and p[1] > regions[-1][-1][1]:
                regions[-1].append(p)
            else:
                regions.append([p])
        for region in regions:
            x = max(begin, done, min(p - q for p, q in region) - slack)
            y = min(end, max(p + size - q for p, q in region) + slack)
            pairs = align(d.plain[x:y].tolist(), template)
            if len(pairs) >= LEAST * size:
                done = x + pairs[-1][0] + 1
                yield [(x + i, j) for i, j in pairs]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text and template found in it: id, license, found (regions), coverage, first_word and last_word of the best."""
    if sum(len(t.split()) for t in templates.values()) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} words")
    # ids travel as text: pandas would make numbers with nulls among them inexact
    rows = docs.select(F.col(id_col).cast("string").alias("__id"), text_of(text_col).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(dict(templates))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Notices(sent.value)
        for b in batches:
            texts, ids = [t.encode() for t in b["__text"]], b["__id"].tolist()
            for lo, hi in chunks(texts):
                out = [(ids[lo + t], own.names[n], found, k / len(own.words[n]), x, y) for t, n, found, k, x, y in own.scan(texts[lo:hi])]
                if out:
                    yield pd.DataFrame(out, columns=[id_col, "license", "found", "coverage", "first_word", "last_word"])

    found = rows.mapInPandas(run, f"`{id_col}` string, license string, found long, coverage double, first_word long, last_word long")
    return found.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))
