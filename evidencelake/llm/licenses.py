"""Licence scans with a generalised suffix automaton over template words.

The automaton holds every run of words of every template. A text's words stream
through it once; after each word it knows the longest run that ends there and
occurs in some template (matching statistics). Maximal runs of some length are
looked up in their templates and chained into covered spans. A short template
must stand in the text word for word, so that one word that sets it apart from
another counts; a longer one must be covered by ``cover``. Where spans overlap,
the one that covers most words stays. Phrases are templates too: a state knows
which phrases end in every run it stands for, so their places are read off the
walk. Licence names and SPDX identifiers are short templates; "licence" counts as
"license" in templates, but never as a place of a phrase.

The score is 1 where a phrase stands, else the best cover of a span that gives a
label; where nothing does, it is the best part of a template times ``cover``, so
a score below ``cover`` means that no label was found.

Defined results: null and empty texts have no words, no places and score 0. Of
spans that cover as many words of one place the first one stays, then the first
label by name. Texts of any length are scanned whole; memory grows with their
words. Rows that repeat stay rows; empty tables give no rows. Other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts, word_bytes

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND '
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE '
    "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
    "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
    "3. This notice may not be removed or altered from any source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
    "software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment "
    "in perpetuity of all present and future rights to this software under copyright law."
)
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
    'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
    "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
_GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program."
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
    "display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"
)

#: Well-known licence texts and notices, as label and text.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", _MIT),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", _APACHE_HEADER),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", _GPL_HEADER),
    ("lgpl", "GNU Lesser General Public License"),
    ("lgpl", "GNU Library General Public License"),
    ("lgpl", _GPL_HEADER.replace("program", "library").replace("General Public", "Lesser General Public")),
    ("agpl", "GNU Affero General Public License"),
    ("agpl", _GPL_HEADER.replace("General Public", "Affero General Public")),
    ("bsd", _BSD_CLAUSES + _BSD_THIRD + _BSD_END),
    ("bsd", _BSD_CLAUSES + _BSD_END),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    ("bsd", "Licensed under the BSD 2-Clause License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", _ISC),
    ("zlib", _ZLIB),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("boost", _BOOST),
    ("unlicense", _UNLICENSE),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("reserved", "All rights reserved."),
)

#: Identifiers of the SPDX list by label; an identifier goes on with "only" or "or later" behind a version.
SPDX = {
    "mit": ("MIT", "MIT-0"),
    "apache": ("Apache-1.1", "Apache-2.0"),
    "gpl": ("GPL-1.0", "GPL-2.0", "GPL-3.0"),
    "lgpl": ("LGPL-2.0", "LGPL-2.1", "LGPL-3.0"),
    "agpl": ("AGPL-3.0",),
    "bsd": ("0BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"),
    "mpl": ("MPL-1.1", "MPL-2.0"),
    "epl": ("EPL-1.0", "EPL-2.0"),
    "eupl": ("EUPL-1.1", "EUPL-1.2"),
    "isc": ("ISC",),
    "zlib": ("Zlib",),
    "boost": ("BSL-1.0",),
    "unlicense": ("Unlicense",),
    "artistic": ("Artistic-2.0",),
    "cc-by": ("CC-BY-3.0", "CC-BY-4.0"),
    "cc-by-sa": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"),
    "cc-by-nc": ("CC-BY-NC-3.0", "CC-BY-NC-4.0"),
    "cc-by-nd": ("CC-BY-ND-3.0", "CC-BY-ND-4.0"),
    "cc-by-nc-sa": ("CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0"),
    "cc-by-nc-nd": ("CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0"),
    "cc0": ("CC0-1.0",),
}
#: Full names that stand for a licence wherever they are.
NAMES = (
    ("mpl", "Mozilla Public License"),
    ("epl", "Eclipse Public License"),
    ("eupl", "European Union Public License"),
    ("boost", "Boost Software License"),
    ("artistic", "Artistic License 2.0"),
    ("isc", "ISC License"),
    ("zlib", "zlib License"),
    ("bsd", "BSD 3-Clause License"),
    ("bsd", "BSD 2-Clause License"),
    ("cc0", "Creative Commons Zero"),
    ("cc-by", "Creative Commons Attribution 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0"),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"),
)
TEMPLATES += NAMES + tuple((label, f"SPDX-License-Identifier: {name}") for label, names in SPDX.items() for name in names)

#: Spellings that templates do not use, and theirs.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"))

#: Templates of up to so many words must stand word for word.
SHORT = 30


class Automaton:
    """Suffix automaton of several word sequences: transitions, links and longest lengths of the states."""

    def __init__(self, sequences: Sequence[Sequence[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)

    def _new(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, symbol: int, target: int) -> int:
        clone = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        target = self.next[last].get(symbol)
        if target is not None:  # another sequence has been here
            return target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target)
        made = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and symbol not in self.next[state]:
            self.next[state][symbol] = made
            state = self.link[state]
        if state >= 0:
            target = self.next[state][symbol]
            self.link[made] = target if self.length[target] == self.length[state] + 1 else self._split(state, symbol, target)
        return made

    def find(self, sequence: Sequence[int]) -> int:
        state = 0
        for symbol in sequence:
            state = self.next[state][symbol]
        return state


class Scanner:
    """The automaton of phrases and templates, and what each of its states stands for."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, least: int = 3, cover: float = 0.6) -> None:
        self.least, self.cover = least, cover
        self.phrases = [(word_bytes(p.encode()), label) for p, label in phrases]
        self.templates = [(label, word_bytes(t.encode())) for label, t in templates]
        self.ids: dict[bytes, int] = {}
        coded = [[self.ids.setdefault(w, len(self.ids)) for w in words] for words in [p for p, _ in self.phrases] + [t for _, t in self.templates]]
        self.ids |= {other.encode(): self.ids[own.encode()] for other, own in SPELLINGS if own.encode() in self.ids and other.encode() not in self.ids}
        self.automaton = auto = Automaton(coded)
        n = len(self.phrases)
        ends: dict[int, list[tuple[int, int]]] = {}
        for k, sequence in enumerate(coded):
            if k < n or len(sequence) <= SHORT:
                ends.setdefault(auto.find(sequence), []).append((k, len(sequence)))
        # a state also ends all phrases and short templates that its shorter suffixes end
        self.ends: list[list[tuple[int, int]]] = [[] for _ in auto.next]
        for state in sorted(range(len(auto.next)), key=auto.length.__getitem__):
            up = auto.link[state]
            self.ends[state] = ends.get(state, []) + (self.ends[up] if up >= 0 else [])
        # where the longest run of each state ends in the templates, with the places of the states below it
        places: list[set[tuple[int, int]]] = [set() for _ in auto.next]
        for k, sequence in enumerate(coded[n:]):
            state = 0
            for i, symbol in enumerate(sequence):
                state = auto.next[state][symbol]
                places[state].add((k, i + 1))
        for state in sorted(range(1, len(auto.next)), key=lambda s: -auto.length[s]):
            if auto.link[state] > 0:
                places[auto.link[state]] |= places[state]
        self.places = [sorted(p) for p in places]

    def scan(self, text: bytes) -> tuple[int, int, int | None, int | None, list[str], list[str], float, list[tuple[str, int, int, float]]]:
        """n_words, places, first and last place, labels of the places, all labels, score, spans (label, first word, word behind, cover)."""
        words = text if isinstance(text, list) else word_bytes(text)
        ids = list(map(self.ids.get, words))
        follow, link, length, ends = self.automaton.next, self.automaton.link, self.automaton.length, self.ends
        phrases = len(self.phrases)
        starts: list[int] = []
        exact: list[tuple[str, int, int, float, int, int]] = []
        base: set[str] = set()
        runs: list[tuple[int, int, int]] = []  # state, length, word behind
        state = size = 0
        for i, symbol in enumerate(ids):
            if symbol is None:
                if size >= self.least:
                    runs.append((state, size, i))
                state = size = 0
                continue
            to = follow[state].get(symbol)
            if to is None:
                if size >= self.least:
                    runs.append((state, size, i))
                while state > 0 and to is None:
                    state = link[state]
                    to = follow[state].get(symbol)
                size = length[state]
            state, size = (to, size + 1) if to is not None else (0, 0)
            for k, n in ends[state]:
                if size < n:
                    continue
                if k < phrases:
                    phrase, label = self.phrases[k]
                    if words[i + 1 - n : i + 1] == phrase:
                        starts.append(i + 1 - n)
                        base.add(label)
                    else:  # in another spelling it is no place of the phrase
                        exact.append((label, i + 1 - n, i + 1, 1.0, n, n))
                else:
                    exact.append((self.templates[k - phrases][0], i + 1 - n, i + 1, 1.0, n, n))
        if size >= self.least:
            runs.append((state, size, len(ids)))
        found = self.chains(runs)
        spans = self.chosen(exact + [s for s in found if s[5] > SHORT and s[3] >= self.cover])
        # a part of a template that is not enough for its label scores below what is
        part = max([self.cover * min(s[3], 0.99) for s in found], default=0.0)
        score = 1.0 if base else max([part, *(s[3] for s in spans)])
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(base | {s[0] for s in spans}), score, spans

    @staticmethod
    def chosen(enough: list[tuple[str, int, int, float, int, int]]) -> list[tuple[str, int, int, float]]:
        """Of spans that overlap by half of the shorter, the one that covers most words."""
        enough = sorted(enough, key=lambda s: (s[1], -s[4], s[0]))
        kept: list[tuple] = []
        at = 0
        while at < len(enough):  # groups of spans that touch one another
            behind, to = enough[at][2], at + 1
            while to < len(enough) and enough[to][1] < behind:
                behind, to = max(behind, enough[to][2]), to + 1
            group: list[tuple] = []
            for s in sorted(enough[at:to], key=lambda s: (-s[4], s[1], s[0])):
                if all(2 * (min(s[2], o[2]) - max(s[1], o[1])) < min(s[2] - s[1], o[2] - o[1]) for o in group):
                    group.append(s)
            kept += sorted(group, key=lambda s: (s[1], s[0]))
            at = to
        return [s[:4] for s in kept]

    def chains(self, runs: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float, int, int]]:
        """Runs that follow one another both in the text and in a template, with gaps, as chains: label, first word, word behind, share of the template, words covered, words of the template."""
        chains: dict[int, list[list[int]]] = {}
        spans: list[tuple[str, int, int, float, int, int]] = []

        def close(k: int, chain: list[int]) -> None:
            label, words = self.templates[k]
            spans.append((label, chain[0], chain[1], min(1.0, chain[3] / len(words)), chain[3], len(words)))

        for state, size, end in runs:
            for k, at in self.places[state]:
                size_here = min(size, at)
                open_chains = chains.setdefault(k, [])
                kept, joined = [], False
                for chain in open_chains:  # first word, word behind, template word behind, words covered
                    if end - size_here - chain[1] > len(self.templates[k][1]):
                        close(k, chain)
                        continue
                    over = max(0, chain[1] - (end - size_here), chain[2] - (at - size_here))
                    if not joined and at > chain[2] and end > chain[1] and over < size_here:
                        chain[1:] = [end, at, chain[3] + size_here - over]
                        joined = True
                    kept.append(chain)
                if not joined:
                    kept.append([end - size_here, end, at, size_here])
                chains[k] = kept
        for k, rest in chains.items():
            for chain in rest:
                close(k, chain)
        return spans


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, least: int = 3, cover: float = 0.6) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row for each row of ``docs``; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    scanner: list[Scanner] = []

    def run(texts: list[bytes]) -> dict[str, pa.Array]:
        if not scanner:
            scanner.append(Scanner(phrases, templates, least, cover))
        rows = [scanner[0].scan(t) for t in texts]
        n, places, first, last, base, labels, score, spans = zip(*rows, strict=True)
        kinds = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("behind", pa.int64()), ("cover", pa.float64())]))
        return {
            "n_words": pa.array(n, pa.int64()), "n_base": pa.array(places, pa.int64()), "first_word": pa.array(first, pa.int64()), "last_word": pa.array(last, pa.int64()),
            "base_labels": pa.array([",".join(b) for b in base], pa.string()), "labels": pa.array([",".join(x) for x in labels], pa.string()), "score": pa.array(score, pa.float64()),
            "spans": pa.array([[dict(zip(("label", "first", "behind", "cover"), s, strict=True)) for s in row] for row in spans], kinds),
        }

    return map_texts(docs, id_col, text_col, run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,behind:long,cover:double>>")
