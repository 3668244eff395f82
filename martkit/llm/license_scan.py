"""License scan by patience alignment of templates with documents.

Words that are unique to both the template and a stretch of text are anchors; the longest
increasing subsequence of the anchors is kept, and the gaps between neighbours are aligned
again in the same way (a gap without anchors is matched from its ends).  Coverage is the
share of the template's words that are aligned.  A template is found in a stretch of text as
long as the template plus a quarter of it and two words on either side, if coverage there
reaches ``min_coverage`` and the aligned words make up ``MIN_COVERAGE`` of template and
aligned stretch together.  So text inserted into a notice beyond that room hides the notice.

Which stretches to align is exact: one that covers the template must hold at least one
of its rarest words whose number exceeds what may be missing, so only stretches around the
occurrences of those words are aligned.  Of findings that overlap, the one that explains
more of the stretch stays.

Defined cases: null and empty texts hold no license; a license repeated in a document is
found each time; a text of any length is scanned whole; an empty table gives an empty
result; only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table
from .phrase_index import words

MIN_COVERAGE = 0.8

# fixed values: license notices as their publishers word them
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (ascending in the first) that also ascends in the second."""
    ends, last, back = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        if at == len(ends):
            ends.append(j)
            last.append(k)
        else:
            ends[at], last[at] = j, k
        back[k] = last[at - 1] if at else -1
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (i in a, j in b), ascending in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        once_a = {w for w, n in Counter(a[a0:a1]).items() if n == 1}
        once_b = {w for w, n in Counter(b[b0:b1]).items() if n == 1}
        at_b = {b[j]: j for j in range(b0, b1) if b[j] in once_b}
        anchors = increasing([(i, at_b[a[i]]) for i in range(a0, a1) if a[i] in once_a and a[i] in at_b])
        if not anchors:  # no word is unique to both: match the ends of the gap
            while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
                found.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
                a1, b1 = a1 - 1, b1 - 1
                found.append((a1, b1))
            continue
        found += anchors
        i0, j0 = a0, b0
        for i, j in [*anchors, (a1, b1)]:
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
    return sorted(found)


class Template:
    def __init__(self, name: str, text: str, min_coverage: float):
        self.name, self.words = name, words(text)
        self.counts = Counter(self.words)
        self.need = max(1, -int(-min_coverage * len(self.words) // 1))
        self.spare = len(self.words) - self.need
        self.offsets = defaultdict(list)
        for k, w in enumerate(self.words):
            self.offsets[w].append(k)

    def stretches(self, places: dict[bytes, list[int]], n: int) -> list[tuple[int, int]]:
        """Stretches of a text that may cover the template, from the words' places in it."""
        if sum(c for w, c in self.counts.items() if w in places) < self.need:
            return []
        rarest = sorted(self.counts, key=lambda w: (len(places.get(w, ())), w))
        out, missing = set(), 0
        slack = len(self.words) // 4 + 2
        for w in rarest:
            for p in places.get(w, ()):
                for k in self.offsets[w]:
                    out.add((max(0, p - k - slack), min(n, p - k + len(self.words) + slack)))
            missing += self.counts[w]
            if missing > self.spare:
                break
        return sorted(out)


def scan(text: str | None, templates: list[Template]) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first word, word after the last) of the findings in a text."""
    w = words(text)
    wanted = {x for t in templates for x in t.counts}
    present = wanted & set(w)
    if not any(sum(c for x, c in t.counts.items() if x in present) >= t.need for t in templates):
        return []
    places = defaultdict(list)
    for k, x in enumerate(w):
        if x in present:
            places[x].append(k)
    found = set()
    for t in templates:
        for low, high in t.stretches(places, len(w)):
            pairs = patience(w[low:high], t.words)
            if len(pairs) >= t.need:
                first, last = low + pairs[0][0], low + pairs[-1][0] + 1
                share = 2 * len(pairs) / (len(t.words) + last - first)
                if share >= MIN_COVERAGE:
                    found.add((share, len(pairs), t.name, len(pairs) / len(t.words), first, last))
    out: list[tuple[str, float, int, int]] = []
    # longer findings first among those that explain their stretch about equally well
    for share, _, name, coverage, first, last in sorted(found, key=lambda f: (-round(f[0], 1), -f[1], -f[0], f[2], f[4])):
        if all(last <= f or first >= e for _, _, f, e in out):
            out.append((name, coverage, first, last))
    return sorted(out, key=lambda f: (f[2], f[0]))


SCHEMA = "doc_id bigint, n_words bigint, license string, coverage double, first_word int, end_word int"


def scan_licenses(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """A row per document and license found, one with a null license where none is."""
    ship(spark)
    texts = TEMPLATES if templates is None else templates

    def run(batches):
        known = [Template(k, v, min_coverage) for k, v in texts.items()]
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0), b.column(1)):
                t = text.as_py()
                n = len(words(t))
                rows += [(doc_id.as_py(), n, *f) for f in scan(t, known)] or [(doc_id.as_py(), n, None, 0.0, None, None)]
            types = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["doc_id", "n_words", "license", "coverage", "first_word", "end_word"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark, table(spark, sf_dir, "documents"))
