"""License notices by patience alignment.

A template is aligned with the place of a text that could hold it: the words that occur once in both are anchors, the longest
increasing subsequence of them is taken, equal words next to an anchor are joined to it, and the gaps are aligned in the
same way. Coverage is the share of the template's words that are aligned.

Places are found without loss: ``LEAST_COVERAGE`` of a template's words have to stand within a stretch of ``STRETCH``
times its length, so only stretches with so many of its words are looked at, the fullest first; what lies in a found notice
is not looked at again. Before a stretch is aligned, bounds that no alignment can pass sort it out: how many pairs of neighbouring words it has to share with the
template, and the length of the longest common subsequence, counted with a bit per template word. Where that lacks k words, the stretches that begin
less than k words away cannot do either, so a text of a license's words in another order costs few looks.

Words that tell licenses apart count besides coverage: a notice's names, numbers and variant words ("Lesser", "NC") all have to be aligned, of a longer
template the first version number and, by the share that coverage asks for, the variant words; a place with more unaligned variant words than
that leaves is another license. Where notices overlap, the one with the most aligned words over those it lacks is reported. The whole texts of the
longer licenses are files beside this module; that of AGPL-3.0 is not among them, so only its notice and header are found.

Defined cases: null and empty texts have no notices; a notice that occurs several times is reported as often; repeated rows are
reported each; of equally full stretches the first is taken; texts of any length are worked on whole; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame

from codetide.llm.common import map_text, whole_text

LEAST_COVERAGE = 0.8
STRETCH = 1.25
#: Words of a notice and of a header or short license at most.
NOTICE, HEADER = 20, 150

# Words that tell variants of a license, and licenses, apart; wordings of public licenses and of the notices that name them.
VARIANTS = frozenset("affero lesser library nc noncommercial sa sharealike nd noderivatives noderivs".split())
NAMES = VARIANTS | frozenset("apache mit isc bsd clause gnu mozilla cc by creative attribution".split())
_CREATIVE = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_GNU = {
    "GPL-2.0": ("General", "2"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3"),
}
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the copyright holder. "
)
_BSD_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT_NOTICE = "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "


def _gnu_header(kind: str, version: str, program: str = "program") -> str:
    return (
        f"This {program} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
        f"{program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details. You should have "
        f"received a copy of the GNU {kind} Public License along with this {program}. If not, see"
    )


TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "MIT notice": "Released under the MIT License",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_DISCLAIMER}"
    ),
    "0BSD": f"{_ISC_GRANT}. {_ISC_DISCLAIMER}",
    "BSD-2-Clause": _BSD_GRANT + _BSD_DISCLAIMER,
    "BSD-3-Clause": f"{_BSD_GRANT}3. {_BSD_ENDORSE}{_BSD_DISCLAIMER}",
    "BSD-4-Clause": f"{_BSD_GRANT}{_BSD_ADVERTISING}4. {_BSD_ENDORSE}{_BSD_DISCLAIMER}",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see"
    ),
    "Apache-1.1 notice": "Licensed under the Apache License, Version 1.1",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, Version 2.0",
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at"
    ),
    "ISC notice": "Released under the ISC License",
    **{f"BSD-{n}-Clause notice": f"Released under the BSD {n}-Clause License" for n in (2, 3)},
    **{f"{name} notice": f"This work is licensed under the GNU {kind} Public License, version {v}" for name, (kind, v) in _GNU.items()},
    **{f"{name} header": _gnu_header(kind, v, "library" if v == "2.1" else "program") for name, (kind, v) in _GNU.items()},
}
for _short, _long in _CREATIVE.items():
    TEMPLATES.setdefault(f"CC-{_short}-4.0 notice", f"This work is licensed under a Creative Commons {_long} 4.0 International License")
    if _short == "BY-NC":
        TEMPLATES["CC-BY-NC-4.0 long notice"] = f"This work is licensed under a Creative Commons {_long} 4.0 International License"
    else:
        TEMPLATES[f"CC-{_short}-4.0 short notice"] = f"Licensed under CC {_short} 4.0"
    TEMPLATES[f"CC-{_short}-4.0 name"] = f"Creative Commons {_long} 4.0 International"
TEMPLATES["MIT-0"] = TEMPLATES["MIT"].replace(_MIT_NOTICE, "")
TEMPLATES |= {path.stem: path.read_text(encoding="utf-8") for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

_word = re.compile(r"[^\W_]+(?:\.\d+)*")


def words_of(text: str) -> list[str]:
    return _word.findall(text.lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        tops[k : k + 1] = [v]
        piles[k : k + 1] = [i]
        before[i] = piles[k - 1] if k else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def aligned(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs (place in the text, place in the template) of aligned words, in order."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(text[a:b], a) if here[w] == 1}
        unique = [(place[w], j) for j, w in enumerate(template[c:d], c) if there[w] == 1 and w in place]
        anchors = [unique[i] for i in longest_increasing([x for x, _ in unique])]
        pairs += anchors
        ends = [(a - 1, c - 1), *anchors, (b, d)]
        if anchors:
            gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends, ends[1:], strict=False)]
    return sorted(pairs)


class Template:
    """Words of a wording, with what its bounds need."""

    def __init__(self, name: str, words: list[str]):
        self.name, self.words, self.vocabulary, self.often = name, words, frozenset(words), Counter(words)
        self.neighbours = frozenset(zip(words, words[1:], strict=False))
        self._bits: dict[str, int] = {}
        for i, w in enumerate(words):
            self._bits[w] = self._bits.get(w, 0) | 1 << i

    def in_order(self, text: list[str]) -> int:
        """Length of the longest common subsequence with a text; a zero bit for each template word that ends a longer one."""
        whole = open_ = (1 << len(self.words)) - 1
        for bits in filter(None, map(self._bits.get, text)):
            taken = open_ & bits
            open_ = (open_ + taken | open_ - taken) & whole
        return len(self.words) - open_.bit_count()


class Fullest:
    """Values of which the first largest is asked for again and again while some change."""

    SIZE = 2048

    def __init__(self, values: np.ndarray):
        self._parts = np.zeros((-(-len(values) // self.SIZE), self.SIZE), dtype=np.int64)
        self.values = self._parts.reshape(-1)
        self.values[: len(values)] = values
        self._most = self._parts.max(axis=1)

    def first(self) -> tuple[int, int]:
        part = int(self._most.argmax())
        at = int(self._parts[part].argmax())
        return part * self.SIZE + at, int(self._parts[part, at])

    def put(self, low: int, values: np.ndarray | int, high: int) -> None:
        low = max(0, low)
        self.values[low:high] = values
        parts = slice(low // self.SIZE, -(-high // self.SIZE))
        self._most[parts] = self._parts[parts].max(axis=1)


class NoticeFinder:
    def __init__(self, templates: dict[str, str], least: float):
        self._least = least
        split = sorted(((name, words) for name, text in templates.items() if (words := words_of(text))), key=lambda t: -len(t[1]))
        self._templates = [Template(name, words) for name, words in split]

    def __call__(self, text: str) -> Iterator[tuple[str, float, int, int]]:
        """(template, coverage, first word, word after the last) of every notice."""
        words = words_of(text)
        present = set(words)
        found, won = [], []
        for template in self._templates:
            common, size = template.vocabulary & present, len(template.words)
            if sum(template.often[w] for w in common) >= self._least * size:
                free = np.ones(len(words), dtype=bool)
                for score, _, first, end, _ in won:
                    if score >= size:  # nothing that is still to come can be better there
                        free[first:end] = False
                places = self._places(words, template, common, free)
                found += [((2 * coverage - 1) * size, *notice, coverage) for *notice, coverage in places]
                won = self._best(found, len(words))
        for _, name, first, end, coverage in won:
            yield name, coverage, first, end

    @staticmethod
    def _best(found: list[tuple], size: int) -> list[tuple]:
        taken, out = np.zeros(size, dtype=bool), []
        for notice in sorted(found, key=lambda f: -f[0]):
            if not taken[notice[2] : notice[3]].any():
                taken[notice[2] : notice[3]] = True
                out.append(notice)
        return out

    def _told(self, words: list[str], template: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether the words that tell licenses apart are those of the template."""
        at, of = {i for i, _ in pairs}, {j for _, j in pairs}
        if len(template) <= NOTICE:
            told = all(j in of for j, w in enumerate(template) if w in NAMES or w[0].isdigit())
            return told and not any(words[i] in VARIANTS and i not in at for i in range(pairs[0][0], pairs[-1][0]))
        if len(template) <= HEADER:
            version = next((j for j in range(1, len(template)) if template[j - 1] in ("version", "v") and template[j][0].isdigit()), None)
            if version is not None and version not in of:
                return False
        variants = [j in of for j, w in enumerate(template) if w in VARIANTS]
        more = sum(words[i] in VARIANTS and i not in at for i in range(pairs[0][0], pairs[-1][0]))
        return sum(variants) >= self._least * len(variants) and more <= (1 - self._least) * len(variants)

    def _places(self, words: list[str], template: Template, common: frozenset, free: np.ndarray) -> Iterator[tuple[str, int, int, float]]:
        size, n = len(template.words), len(words)
        need, width = self._least * size, int(STRETCH * size) + 1
        hits = np.fromiter((w in common for w in words), dtype=np.int64, count=n)

        def inside(low: int, high: int) -> np.ndarray:
            """Free words of the template in the stretch from each word on."""
            sums = np.concatenate([[0], np.cumsum((hits * free)[low : high + width])])
            return sums[np.minimum(np.arange(high - low) + width, len(sums) - 1)] - sums[: high - low]

        full = inside(0, n) * hits * free
        if full.max(initial=0) < need:
            return
        full[self._shared(words, width, template.often) < need] = 0
        # Of k aligned pairs all but this many follow each other in both: a gap costs a word of the stretch or of the template.
        tight = 3 * need - size - width - 1
        if tight > 0:
            pairs = zip(words, words[1:], strict=False)
            paired = np.concatenate([[0], np.cumsum(np.fromiter((p in template.neighbours for p in pairs), dtype=np.int64, count=n - 1))])
            ends = np.minimum(np.arange(n) + width - 1, n - 1)
            full[paired[ends] - paired[np.minimum(np.arange(n), n - 1)] < tight] = 0
        fullest = Fullest(full)
        while True:
            start, most = fullest.first()
            if most < need:
                return
            # The fullest stretch may begin with stray words and end within the notice, so the alignment looks one template further.
            taken = [i for i in range(start, min(start + width + size, n)) if free[i]]
            looked = [words[i] for i in taken]
            lacking = math.ceil(need - template.in_order(looked))
            if lacking > 0:
                fullest.put(start - lacking + 1, 0, min(start + lacking, n))
                continue
            pairs = self._within(width, [(taken[i], j) for i, j in aligned(looked, template.words)])
            coverage = len(pairs) / size
            told = coverage >= self._least and self._told(words, template.words, pairs)
            if told:
                yield template.name, pairs[0][0], pairs[-1][0] + 1, coverage
            fullest.put(start, 0, start + 1)
            if told or coverage >= self._least and size > HEADER:  # a whole text of another license holds no notice of this one
                low, high = max(0, pairs[0][0] - width), pairs[-1][0] + 1
                free[pairs[0][0] : high] = False
                still = (fullest.values[low:high] > 0) & free[low:high]
                fullest.put(low, inside(low, high) * still, high)

    @staticmethod
    def _shared(words: list[str], width: int, often: Counter) -> np.ndarray:
        """Of the stretch from each word on: its words that the template has, each as often as in the template at most."""
        here, total, out = Counter(), 0, np.zeros(len(words), dtype=np.int64)
        for i in range(len(words) - 1, -1, -1):
            here[words[i]] += 1
            total += here[words[i]] <= often[words[i]]
            if i + width < len(words):
                gone = words[i + width]
                total -= here[gone] <= often[gone]
                here[gone] -= 1
            out[i] = total
        return out

    @staticmethod
    def _within(width: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The most pairs in a row that a stretch of the text holds."""
        low, best = 0, (0, 0)
        for high in range(len(pairs)):
            while pairs[high][0] - pairs[low][0] >= width:
                low += 1
            best = max(best, (high + 1 - low, -low))
        return pairs[-best[1] : best[0] - best[1]]


_form = re.compile(r" ((?:short |long )?notice|header|name)$")
_finders: dict[tuple, NoticeFinder] = {}


def _finder(templates: dict[str, str], least: float) -> NoticeFinder:
    key = (tuple(templates.items()), least)
    if key not in _finders:
        _finders.clear()
        _finders[key] = NoticeFinder(templates, least)
    return _finders[key]


def license_and_form(template: str) -> tuple[str, str]:
    """The license that a template belongs to, and whether it is its text or one of the ways to name it."""
    form = _form.search(template)
    return (template[: form.start()], form[1]) if form else (template, "text")


def find_notices(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """doc_id, license, form, coverage, first_word, end_word: a row for every notice found."""
    templates = dict(templates or TEMPLATES)

    def run(rows: list[dict]) -> Iterator[dict]:
        find = _finder(templates, least)
        for row in rows:
            for template, coverage, first, end in find(row["text"]):
                name, form = license_and_form(template)
                yield {"doc_id": row["doc_id"], "license": name, "form": form, "coverage": coverage, "first_word": first, "end_word": end}

    out = "doc_id long, license string, form string, coverage double, first_word long, end_word long"
    return map_text(docs.select("doc_id", whole_text().alias("text")), run, out)
