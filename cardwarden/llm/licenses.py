"""License scans by patience alignment.

A text and a license template are aligned as lists of words: words that occur
exactly once in both are anchors, the longest run of anchors in the same order on
both sides is kept, and the gaps between them are aligned in the same way, after
their common beginning and end. Coverage is the share of the template's words
that found their partner.

Licenses of one family share most of their words, so coverage alone does not tell
them apart: a template counts only where the text also says its name, version or
clause, and not what sets a sibling apart (``NAMED``, ``BARRED``).

A template is only aligned with stretches of a text that hold enough of its words
to reach the wanted coverage; that test drops nothing that could reach it. Texts
stay where they are, the templates are a fixed table.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cardwarden.llm.frames import texts

COVERAGE = 0.8

# Texts that licenses of one family share.
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    'without fee is hereby granted{}. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. {} "
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BINARY = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU {0} as published by the Free Software Foundation, either version {1} of "
    "the License, or (at your option) any later version. This program is distributed in the hope "
    "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
)

# Published license notices and texts, by SPDX identifier and form.
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT/line": "Released under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "MIT-0/line": "Released under the MIT No Attribution License.",
    "ISC/line": "Released under the ISC License.",
    "ISC/text": _ISC.format(
        ", provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "0BSD/text": _ISC.format(""),
    "BSD-1-Clause/text": _BSD.format(""),
    "BSD-2-Clause/line": "Released under the 2-Clause BSD License.",
    "BSD-2-Clause/text": _BSD.format(_BINARY),
    "BSD-3-Clause/line": "Released under the 3-Clause BSD License.",
    "BSD-3-Clause/text": _BSD.format(f"{_BINARY} 3. {_ENDORSE}"),
    "BSD-4-Clause/text": _BSD.format(
        f"{_BINARY} 3. All advertising materials mentioning features or use of this software must display "
        "the following acknowledgement: This product includes software developed by the organization. "
        f"4. {_ENDORSE}"
    ),
    "LicenseRef-BSD/line": "Released under the BSD License.",  # does not say which one
    "Apache-1.1/line": "Licensed under the Apache License, Version 1.1.",
    "BSL-1.0/line": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-1.0/line": "Licensed under the Eclipse Public License, Version 1.0.",
    "EPL-2.0/line": "Licensed under the Eclipse Public License, Version 2.0.",
    "CC0-1.0/line": "Released under CC0 1.0 Universal.",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense/text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any "
        "and all copyright interest in the software to the public domain. We make this dedication for the "
        "benefit of the public at large and to the detriment of our heirs and successors. We intend this "
        "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        'this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}
TEMPLATES["MIT-0/text"] = re.sub(
    ", subject to the following conditions:.*?portions of the Software", "", TEMPLATES["MIT/text"]
)

# What a text must say for a template to count, and what it must not say. Coverage alone cannot
# tell licenses of one wording apart. Each phrase stands word for word; "|" parts other ways to say it.
NAMED: dict[str, tuple[str, ...]] = {
    "Apache-2.0/line": ("apache license", "version 2|v2|v 2|2 0"),
    "Apache-2.0/header": ("apache license", "version 2|v2|v 2|2 0"),
    "Apache-1.1/line": ("apache license", "1 1"),
    "MIT/line": ("mit license",),
    "MIT/text": ("subject to the following|included in all|substantial portions|permission notice",),
    "MIT-0/line": ("mit no attribution|mit 0",),
    "ISC/line": ("isc license",),
    "ISC/text": ("provided that|copyright notice|permission notice|appear in all",),
    "BSD-2-Clause/line": ("2 clause bsd|two clause bsd|bsd 2 clause|simplified bsd|freebsd",),
    "BSD-2-Clause/text": ("in binary form",),
    "BSD-3-Clause/line": ("3 clause bsd|three clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd",),
    "BSD-3-Clause/text": ("in binary form", "endorse|promote"),
    "BSD-4-Clause/text": ("in binary form", "advertising materials"),
    "LicenseRef-BSD/line": ("the bsd license|a bsd license|bsd style license",),
    "BSL-1.0/line": ("boost software license", "1 0"),
    "EPL-1.0/line": ("eclipse public license", "1 0"),
    "EPL-2.0/line": ("eclipse public license", "2 0"),
    "CC0-1.0/line": ("cc0",),
    "MPL-2.0/header": ("mozilla public license", "2 0"),
    "Unlicense/text": ("unencumbered|public domain",),
}
BARRED: dict[str, str] = {
    "MIT/text": "except as contained in this notice",
    "MIT-0/text": "subject to the following|included in all|substantial portions|permission notice",
    "ISC/text": "supporting documentation",
    "0BSD/text": "copyright notice|permission notice|appear in all",
    "BSD-1-Clause/text": "in binary form",
    "BSD-2-Clause/text": "endorse|promote|advertising materials",
    "BSD-3-Clause/text": "advertising materials",
}
GAP = 4  # words more than in the template that may lie between two phrases
AFTER = 12  # words behind a match that must not hold a barred phrase


def _families() -> None:
    """Adds the GNU licenses, Creative Commons and SPDX tags, which differ by name and version only."""
    versions = {"1": "version 1|v1|v 1|1 0", "2": "version 2|v2|v 2|2 0", "3": "version 3|v3|v 3|3 0"}
    versions["2.1"] = "version 2 1|v2 1|v 2 1|2 1"
    for kind, name, version in (
        ("GPL-1.0", "General Public License", "1"),
        ("GPL-2.0", "General Public License", "2"),
        ("GPL-3.0", "General Public License", "3"),
        ("LGPL-2.0", "Library General Public License", "2"),
        ("LGPL-2.1", "Lesser General Public License", "2.1"),
        ("LGPL-3.0", "Lesser General Public License", "3"),
        ("AGPL-3.0", "Affero General Public License", "3"),
    ):
        line = f"This work is licensed under the GNU {name}, version {version}."
        for form, text in (("line", line), ("header", _GNU.format(name, version))):
            TEMPLATES[f"{kind}/{form}"] = text
            NAMED[f"{kind}/{form}"] = (f"gnu {name.lower()}", versions[version])

    names = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    apart = {
        "noncommercial": "non commercial", "sharealike": "share alike", "noderivatives": "noderivs",
        "noderivs": "no derivatives",
    }
    for code in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        for version, place in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
            kind = f"CC-{code}-{version}"
            long = "-".join(names[c] for c in code.split("-"))
            short_form, long_form = "short line", "long line"
            if kind == "CC-BY-NC-4.0":
                short_form = "line"
            elif kind == "CC-BY-4.0":
                long_form = "line"
            TEMPLATES[f"{kind}/{short_form}"] = f"Licensed under CC {code} {version}."
            TEMPLATES[f"{kind}/{long_form}"] = (
                f"This work is licensed under a Creative Commons {long} {version} {place} License."
            )
            said = [long.lower().replace("-", " ")]
            for one, other in apart.items():
                said += [t.replace(one, other) for t in said if one in t]
            number = version.replace(".", " ")
            NAMED[f"{kind}/{long_form}"] = ("|".join(f"{t} {v}{number}" for t in said for v in ("", "version ", "v")),)
            letters = f"cc {code.lower().replace('-', ' ')}"
            NAMED[f"{kind}/{short_form}"] = ("|".join(f"{letters} {v}{number}" for v in ("", "version ", "v")),)

    tag = "SPDX-License-Identifier"
    for kind in sorted({name.partition("/")[0] for name in TEMPLATES if not name.startswith("LicenseRef")}):
        TEMPLATES[f"{kind}/tag"] = f"{tag}: {kind}"
        NAMED[f"{kind}/tag"] = ("spdx license identifier", " ".join(_WORD.findall(kind.lower())))
    BARRED["MIT/tag"] = "mit 0"
    BARRED["BSD-2-Clause/tag"] = "2 clause patent|2 clause views"
    BARRED["BSD-3-Clause/tag"] = "3 clause clear|3 clause attribution|3 clause lbnl|3 clause no"

_WORD = re.compile(r"\w+")
_PART = 1 << 20
_families()


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def matched(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Pairs (place in ``left``, place in ``right``) of the patience alignment, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        anchors = _in_order(_unique_in_both(left[a:b], right[c:d]))
        if not anchors:
            continue
        edges = [(a - 1, c - 1), *((a + i, c + j) for i, j in anchors), (b, d)]
        out += edges[1:-1]
        todo += [
            (i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m
        ]
    return sorted(out)


def _unique_in_both(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    once_left = {w for w, n in Counter(left).items() if n == 1}
    once = once_left & {w for w, n in Counter(right).items() if n == 1}
    place = {w: j for j, w in enumerate(right) if w in once}
    return [(i, place[w]) for i, w in enumerate(left) if w in once]


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that grows on both sides (patience sorting)."""
    tops: list[int] = []  # the smallest right place that ends a run of each length
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            ends.append(k)
        else:
            tops[pile], ends[pile] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _ways(phrase: str) -> list[list[str]]:
    return [way.split() for way in phrase.split("|")]


def _spans(words: list[str], ways: Iterable[list[str]]) -> list[tuple[int, int]]:
    """(first word, last word + 1) wherever one of the ways stands word for word."""
    return [
        (at, at + len(way))
        for way in ways
        for at, w in enumerate(words)
        if w == way[0] and words[at : at + len(way)] == way
    ]


def _gap(a: tuple[int, int], b: tuple[int, int]) -> int:
    return max(b[0] - a[1], a[0] - b[1], 0)


class Templates:
    def __init__(
        self,
        templates: dict[str, str],
        coverage: float,
        named: dict[str, tuple[str, ...]] | None = None,
        barred: dict[str, str] | None = None,
    ):
        self.coverage = coverage
        self.named = {name: [_ways(p) for p in phrases] for name, phrases in (named or {}).items()}
        self.barred = {name: _ways(p) for name, p in (barred or {}).items()}
        self.words = {name: words_of(t) for name, t in templates.items() if words_of(t)}
        self.counts = {name: Counter(w) for name, w in self.words.items()}
        self.every = {w for words in self.words.values() for w in words}
        self.every |= {w for phrases in self.named.values() for ways in phrases for way in ways for w in way}
        # Words that every way of saying a template's phrases has.
        self.sure = {
            name: frozenset().union(*(set.intersection(*map(set, ways)) for ways in self.named.get(name, ())))
            for name in self.words
        }
        self.gaps = {name: GAP + self._apart(name) for name in self.words}

    def _apart(self, name: str) -> int:
        """The most words that lie between the first phrase of a template and another one."""
        words, phrases = self.words[name], self.named.get(name, [])
        first, *others = [_spans(words, ways) for ways in phrases] or [[]]
        return max((min((_gap(a, b) for a in first for b in spans), default=0) for spans in others), default=0)

    def says(self, name: str, words: list[str]) -> bool:
        """Whether the words hold what names a template: its phrases, near the first of them."""
        first, *others = [_spans(words, ways) for ways in self.named.get(name, [])] or [[(0, 0)]]
        return any(
            all(any(_gap(a, b) <= self.gaps[name] for b in spans) for spans in others) for a in first
        )

    def found(self, words: list[str]) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, last word + 1) of each best match in a list of words."""
        places: dict[str, list[int]] = {}
        for at, w in enumerate(words):
            if w in self.every:
                places.setdefault(w, []).append(at)
        out = []
        for name, template in self.words.items():
            if not self.sure[name] <= places.keys():
                continue
            count, need = self.counts[name], self.coverage * len(template)
            if sum(min(n, len(places.get(w, ()))) for w, n in count.items()) < need:
                continue
            best = (0.0, 0, 0)
            for lo, hi in self._stretches(places, count, len(template), need, len(words)):
                pairs = matched(words[lo:hi], template)
                share = len(pairs) / len(template)
                if not pairs or share < self.coverage or share <= best[0]:
                    continue
                start, stop = lo + pairs[0][0], lo + pairs[-1][0] + 1
                if _spans(words[start : stop + AFTER], self.barred.get(name, ())):
                    continue
                if self.says(name, words[lo : hi + AFTER]):
                    best = (share, start, stop)
            if best[0]:
                out.append((name, *best))
        return out

    @staticmethod
    def _stretches(
        places: dict, count: Counter, size: int, need: float, end: int
    ) -> Iterator[tuple[int, int]]:
        """Stretches of at most twice the template that hold enough of its words, joined if they overlap.

        Each begins and ends at a template word, so other words beside a match
        do not hide its anchors more than they must.
        """
        spots = sorted((at, w) for w in count for at in places.get(w, ()))
        wide, lo, enough = 2 * size + 2, 0, 0
        held: Counter = Counter()
        open_: list[int] | None = None
        for at, w in spots:
            held[w] += 1
            enough += held[w] <= count[w]
            while at - spots[lo][0] >= wide:
                gone = spots[lo][1]
                enough -= held[gone] <= count[gone]
                held[gone] -= 1
                lo += 1
            if enough < need:
                continue
            # The tightest stretch that ends here: drop what is not needed in front.
            while held[spots[lo][1]] > count[spots[lo][1]]:
                held[spots[lo][1]] -= 1
                lo += 1
            start = spots[lo][0]
            if open_ and start < open_[0] + size and at - open_[0] < wide:
                open_[1] = at + 1
            else:
                if open_:
                    yield open_[0], open_[1]
                open_ = [start, at + 1]
        if open_:
            yield open_[0], open_[1]


def _parts(text: str, overlap: int) -> Iterator[tuple[int, list[str]]]:
    """(number of the first word, words) of parts of a very long text, overlapping."""
    held: list[str] = []
    before = at = 0
    while True:
        cut = re.compile(r"\W").search(text, at + _PART) if at + _PART < len(text) else None
        stop = cut.start() if cut else len(text)
        held += words_of(text[at:stop])
        yield before, held
        if stop >= len(text):
            return
        before += max(0, len(held) - overlap)
        held, at = held[-overlap:], stop


def licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE
) -> DataFrame:
    """(doc_id, th, license, form, coverage, first_word, last_word) for every template a text holds.

    A text holds a template when some stretch of it covers at least ``coverage``
    of the template's words and names it; the best stretch is reported, the first among
    equals. Null, empty and wordless texts hold none. Repeated rows are reported
    each; a null doc_id stays null; an empty table gives no rows; further columns
    are ignored. ``first_word`` and ``last_word`` count the text's words from 0;
    ``last_word`` is one past the end.
    """
    known = TEMPLATES if templates is None else templates
    rules = (NAMED, BARRED) if templates is None else ()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Templates(known, coverage, *rules)
        overlap = 4 * max((len(w) for w in table.words.values()), default=0) + 8
        for batch in batches:
            out = []
            for doc, th, text in zip(*(batch.column(c) for c in ("doc_id", "th", "text"))):
                best: dict[str, tuple[float, int, int]] = {}
                for before, words in _parts(text.as_py(), overlap):
                    for name, share, lo, hi in table.found(words):
                        if share > best.get(name, (0.0,))[0]:
                            best[name] = (share, before + lo, before + hi)
                for name, (share, lo, hi) in best.items():
                    kind, _, form = name.partition("/")
                    out.append((doc.as_py(), th.as_py(), kind, form, share, lo, hi))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names
                )

    names = ["doc_id", "th", "license", "form", "coverage", "first_word", "last_word"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
    return texts(docs).mapInArrow(
        scan,
        "doc_id long, th long, license string, form string, coverage double, "
        "first_word long, last_word long",
    )
