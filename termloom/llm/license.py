"""Operator 4: licence notices in whole texts, by patience alignment.

Text and template become lower-case words without punctuation.  A notice can
only be covered where enough of its words stand close together; a running count
over the text finds all such stretches, as a bound that loses nothing.  On each
stretch the alignment anchors on words that occur once in both, takes their
longest increasing subsequence, and aligns the gaps between anchors in the same
way; what has no unique words is matched from both ends.  Coverage is the share
of the template's words that are aligned.  Of the aligned words only those count
that stand within the best window, so far-off matches don't add up.  Phrases that
tell one licence from another (its name, its version) must be aligned word for
word.  A short statement is the same alignment of a sentence that ends in a
licence's name, all of which must stand there; a family's name without a version
that is known gives the family alone (GPL, BSD, Apache).  Names joined by "or" or
"and" count each; so does what follows an SPDX tag.  A statement that holds a
denial, or has one up to two words before it in its sentence, is none.

The library: whole notices of MIT, ISC, BSD-2-Clause, BSD-3-Clause, MPL-2.0,
Unlicense and Zlib, the usual file headers of Apache-2.0, GPL, LGPL and AGPL, and
the names of these and of CC0, CC-BY and its kin, EPL, BSL, Artistic, EUPL and
WTFPL.  Full texts of the long licences have no template of their own.

Defined results: a row for each notice found; documents without one have none; a
null text has no words; a very long text is read whole; repeated rows give repeated notices; equal coverage goes
to the longer template, then to the first name; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.common import arrow_map, only

WORD = re.compile(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*")
#: Share of a template's words that must be aligned, and how much longer than the template a stretch may be.
COVERAGE, STRETCH = 0.8, 1.4

# Public licence notices, by SPDX name, and phrases that must stand in the text as they are.
_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_CLAUSES = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_GNU = "This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
NOTICES = {
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", ()),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.", ()),
    "BSD-2-Clause": (f"{_CLAUSES} {_WARRANTY}", ()),
    "BSD-3-Clause": (f"{_CLAUSES} {_THIRD} {_WARRANTY}", ("endorse or promote products",)),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", ("apache license version 2.0",)),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", ("mozilla public license v 2.0",)),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ("unencumbered software",)),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.", ()),
    **{f"{spdx}-or-later": (_GNU.format(what=what, name=name, version=version), (name, f"version {version} of the license")) for spdx, what, name, version in [("GPL-2.0", "program", "GNU General Public License", "2"), ("GPL-3.0", "program", "GNU General Public License", "3"), ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "library", "GNU Lesser General Public License", "3"), ("AGPL-3.0", "program", "GNU Affero General Public License", "3")]},
}

# Sentences that put a work under a licence, whose name stands at {}.
STATEMENTS = ["licensed under {}", "released under {}", "distributed under {}", "available under {}", "licensed under the {}", "released under the {}", "distributed under the {}", "distributed under the terms of the {}", "available under the {}", "published under the {}", "this work is licensed under a {}", "this work is licensed under the {}"]

# The tag before an identifier, its endings and what is kept of them; words that join names; words that deny, and the end of a sentence.
TAG, TAG_ENDS = "spdx-license-identifier", {"-or-later": "-or-later", "-only": ""}
JOINING = {"or", "and"}
DENIALS = {"not", "never", "neither", "nor", "cannot", "isn't", "aren't", "wasn't"}
SENTENCE_END = re.compile(r"[.!?;\n]")
#: Words before a statement in which a denial counts.
DENIED_BEFORE = 2


def licence_names() -> list[tuple[str, str]]:
    """(SPDX name, name as written) of common licences; families by their rule, without a version as the family alone."""
    out = [("MIT", "MIT License"), ("MIT", "MIT"), ("ISC", "ISC License"), ("Unlicense", "Unlicense"), ("Zlib", "zlib License"), ("WTFPL", "WTFPL"), ("CC0-1.0", "CC0"), ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "Creative Commons Zero"), ("BSD", "BSD License"), ("BSD", "BSD")]
    out += [(f"BSD-{n}-Clause", name) for n in "234" for name in (f"BSD {n}-Clause License", f"{n}-Clause BSD License", f"BSD-{n}-Clause", f"BSD {n}-Clause")]
    for spdx, name, versions in [("Apache", "Apache", ("1.0", "1.1", "2.0")), ("MPL", "Mozilla Public", ("1.0", "1.1", "2.0")), ("EPL", "Eclipse Public", ("1.0", "2.0")), ("BSL", "Boost Software", ("1.0",)), ("Artistic", "Artistic", ("1.0", "2.0")), ("EUPL", "European Union Public", ("1.1", "1.2"))]:
        out += [(spdx, f"{name} License"), (spdx, f"{spdx} License")]
        out += [(f"{spdx}-{v}", f) for v in versions for f in (f"{name} License, Version {v}", f"{name} License {v}", f"{name} License v{v}", f"{spdx} {v}", f"{spdx}-{v}")]
    for spdx, name, versions in [("GPL", "General Public License", ("1", "2", "3")), ("LGPL", "Lesser General Public License", ("2", "2.1", "3")), ("AGPL", "Affero General Public License", ("1", "3"))]:
        for own in (f"GNU {name}", name, f"GNU {spdx}", spdx):
            out += [(spdx, own), (spdx, f"{own} License")]
            for v in versions:
                full = v if "." in v else f"{v}.0"
                out += [(f"{spdx}-{full}", f"{own}{link}{w}") for w in {v, full} for link in (", version ", " version ", " v", " ", "v", "-")]
    for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        words = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
        spoken = "-".join(words[x] for x in parts.split("-"))
        for own in (f"CC {parts}", f"CC-{parts}", f"Creative Commons {spoken}"):
            out += [(f"CC-{parts}", own), *((f"CC-{parts}-{v}", f"{own}{link}{v}{end}") for v in ("2.0", "2.5", "3.0", "4.0") for link in (" ", "-") for end in ("", " License", " International License"))]
    return out


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Words with their places in text; lowering keeps places where it keeps lengths, else letter by letter."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return [(m[0], *m.span()) for m in WORD.finditer(low)]


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (sorted by the first) whose seconds increase."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(piles[at - 1] if at else -1)
        tops[at : at + 1] = [b]
        piles[at : at + 1] = [i]
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of equal words, both increasing."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = rising([(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in where])
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if k - i > 1 and m - j > 1:
                todo.append((i + 1, k, j + 1, m))
    return sorted(out)


class Template:
    """A notice: its words, and phrases of it that must be aligned word for word."""

    def __init__(self, name: str, text: str, phrases: tuple[str, ...], coverage: float) -> None:
        self.name, self.words = name, [w for w, _, _ in words_of(text)]
        self.bag = set(self.words)
        self.need = -(-len(self.words) * coverage // 1)
        self.span = int(len(self.words) * STRETCH) + 1
        self.phrases = [[j for j in range(len(self.words) - len(p) + 1) if self.words[j : j + len(p)] == p] for p in self._split(phrases)]
        self.sizes = [len(p) for p in self._split(phrases)]
        # any text that covers the template has one of these words: together they are more than may be missing
        self.signs: set[str] = set()
        self.counts = counts = Counter(self.words)
        for w in sorted(counts, key=lambda w: (-len(w), w)):
            if sum(counts[s] for s in self.signs) > len(self.words) - self.need:
                break
            self.signs.add(w)
        self.triples: dict[tuple, list[int]] = {}
        for j in range(len(self.words) - 2):
            self.triples.setdefault(tuple(self.words[j : j + 3]), []).append(j)

    @staticmethod
    def _split(phrases: tuple[str, ...]) -> list[list[str]]:
        return [[w for w, _, _ in words_of(p)] for p in phrases]

    def stretches(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of text in which some window of `span` words has `need` of the template's words."""
        here = np.fromiter((w in self.bag for w in words), np.int64, len(words))
        total = np.concatenate(([0], np.cumsum(here)))
        n = len(words)
        lo = np.arange(max(1, n - self.span + 1))
        hi = np.minimum(lo + self.span, n)
        full = np.flatnonzero(total[hi] - total[lo] >= self.need)
        out: list[tuple[int, int]] = []
        for i in full.tolist():
            if out and i <= out[-1][1]:
                out[-1] = out[-1][0], min(n, i + self.span)
            else:
                out.append((i, min(n, i + self.span)))
        return out

    def within(self, words: list[str], lo: int, hi: int) -> tuple[int, int, int] | None:
        """(first, end, aligned words) of the best alignment with words[lo:hi], if it covers the template."""
        pairs = patience(self.words, words[lo:hi])
        if len(pairs) < self.need:
            return None
        # of far-off matches only the most that stand within `span` words count
        best, a = (0, 0), 0
        for b in range(len(pairs)):
            while pairs[b][1] - pairs[a][1] >= self.span:
                a += 1
            if b - a >= best[1] - best[0]:
                best = a, b + 1
        a, b = best
        if b - a < self.need:
            return None
        first, end = lo + pairs[a][1], lo + pairs[b - 1][1] + 1
        nearer = patience(self.words, words[first:end])
        at = {i: j + first for i, j in nearer} if len(nearer) >= b - a else {i: j + lo for i, j in pairs[a:b]}
        for places, size in zip(self.phrases, self.sizes, strict=True):
            if not any(all(at.get(j + k, -1) == at[j] + k for k in range(size)) for j in places if j in at):
                return None
        return min(at.values()), max(at.values()) + 1, len(at)

    def best(self, words: list[str], lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(first, end, aligned words) of the notices between lo and hi, which may hold several.

        Where most triples of template and text agree on a start, the window
        around it is aligned first, and the first that covers the template counts;
        if none does, the windows of `span` words from every start are tried in
        turn.  Patience alignment is no longest common subsequence: repeated words
        may hide a notice that is cut about.
        """
        found, todo = [], [(lo, hi)]
        slack = self.span - len(self.words)
        while todo:
            a, b = todo.pop()
            if b - a < self.need:
                continue
            votes: Counter = Counter()
            for i in range(a, b - 2):
                for j in self.triples.get((words[i], words[i + 1], words[i + 2]), ()):
                    votes[i - j] += 1
            tried: list[int] = []
            hits = []
            for start, _ in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
                if all(abs(start - t) > slack for t in tried):
                    tried.append(start)
                    if hit := self.within(words, max(a, start - slack), min(b, start + len(self.words) + slack)):
                        hits.append(hit)
                        break
            if not hits:
                for start in range(a, b - int(self.need) + 1):
                    if words[start] in self.bag:
                        end = min(b, start + self.span)
                        if (self.counts & Counter(words[start:end])).total() >= self.need and (hit := self.within(words, start, end)):
                            hits.append(hit)
                            break
            if hits:
                found.append(hits[0])
                todo += [(a, hits[0][0]), (hits[0][1], b)]
        return found


class Statements:
    """Short sentences that name a licence: all words of the name must stand together, the sentence before it mostly."""

    def __init__(self, coverage: float, names: list[tuple[str, str]] | None = None) -> None:
        self.coverage = coverage
        self.by_word: dict[str, list[tuple[str, list[str]]]] = {}
        seen = set()
        for spdx, name in names if names is not None else licence_names():
            own = [w for w, _, _ in words_of(name)]
            if tuple(own) not in seen:
                seen.add(tuple(own))
                self.by_word.setdefault(own[0], []).append((spdx, own))
        self.forms = [[w for w, _, _ in words_of(x.format(""))] for x in STATEMENTS]
        self.reach = 2 * max(map(len, self.forms))

    def named(self, words: list[str], i: int) -> tuple[int, str] | None:
        """(words of it, licence) of the longest name that begins at i."""
        found = max(((len(own), spdx) for spdx, own in self.by_word.get(words[i], ()) if words[i : i + len(own)] == own), default=None) if i < len(words) else None
        if not found and i < len(words):  # identifiers that end so are one word
            for end, kept in TAG_ENDS.items():
                if words[i].endswith(end) and (base := self.named([words[i].removesuffix(end)], 0)):
                    return base[0], base[1] + kept
        return found

    def further(self, words: list[str], i: int) -> list[tuple[int, int, str]]:
        """(place, words of it, licence) of the names joined by "or" or "and" to one that ends at i."""
        out = []
        while i < len(words) and words[i] in JOINING:
            while i < len(words) and words[i] in JOINING | {"the", "a", "under"}:
                i += 1
            if not (name := self.named(words, i)):
                break
            out.append((i, *name))
            i += name[0]
        return out

    def notices(self, words: list[str], bag: set[str]) -> list[tuple[str, int, int, int, int]]:
        """(licence, words of the statement, aligned ones, first, end) of every name with a sentence or a tag before it.

        A further name joined to the first has the same sentence, and its own place.
        """
        out: list[tuple[str, int, int, int, int]] = []
        if TAG in bag:
            for i, w in enumerate(words):
                if w == TAG and (name := self.named(words, i + 1)):
                    out.append((name[1], 1 + name[0], 1 + name[0], i, i + 1 + name[0]))
                    out += [(spdx, 1 + n, 1 + n, j, j + n) for j, n, spdx in self.further(words, i + 1 + name[0])]
        known = self.by_word.keys() & bag
        if not known or "under" not in bag:
            return out
        for i, w in enumerate(words):
            if w in known:
                name = self.named(words, i)
                if name:
                    size, spdx = name
                    lo = max(0, i - self.reach)
                    tries = []
                    for form in self.forms:
                        pairs = [(a, b) for a, b in patience(form, words[lo:i]) if i - lo - b <= STRETCH * (len(form) - a) + 1]
                        if pairs and len(pairs) + size >= self.coverage * (len(form) + size) and "under" in {form[a] for a, _ in pairs}:
                            tries.append((len(pairs) - len(form), len(pairs), len(form) + size, lo + pairs[0][1]))
                    if tries:
                        _, n, total, first = max(tries)
                        out.append((spdx, total, n + size, first, i + size))
                        out += [(other, total - size + m, n + m, j, j + m) for j, m, other in self.further(words, i + size)]
        return out


def denied(text: str, placed: list[tuple[str, int, int]], first: int, end: int) -> bool:
    """Whether a word that denies stands in a statement, or just before it in the same sentence."""
    lo = max(0, first - DENIED_BEFORE)
    denies = lambda j: placed[j][0] in DENIALS or placed[j][0] == "no" and placed[j + 1][0] == "longer"
    return any(denies(j) and (j >= first or not SENTENCE_END.search(text[placed[j][2] : placed[first][1]])) for j in range(lo, end - 1))


class Library:
    """All that is looked for, made once a task."""

    def __init__(self, coverage: float, texts: dict[str, tuple[str, tuple[str, ...]]], names: list[tuple[str, str]] | None = None) -> None:
        self.templates = [Template(name, text, phrases, coverage) for name, (text, phrases) in texts.items()]
        self.signs = set().union(*(t.signs for t in self.templates))
        self.statements = Statements(coverage, names)


def notices(text: str, library: Library) -> list[tuple[str, int, int, int, int]]:
    """(licence, template's words, aligned words, start, end) with places in text; of overlapping ones the best stays."""
    if not text:
        return []
    placed = words_of(text)
    words = [w for w, _, _ in placed]
    bag = set(words)
    stated, no = library.statements.notices(words, bag), -1
    out = []
    for name, n, k, a, b in stated:
        # names joined to a denied one are denied with it
        if denied(text, placed, a, b) or 0 <= no <= a and a - no <= len(JOINING) + 3 and not SENTENCE_END.search(text[placed[no - 1][2] : placed[a][1]]):
            no = b
        else:
            out.append((name, n, k, placed[a][1], placed[b - 1][2]))
    if not library.signs.isdisjoint(bag):
        for t in library.templates:
            if t.signs.isdisjoint(bag) or len(words) < t.need:
                continue
            for lo, hi in t.stretches(words):
                for a, b, n in t.best(words, lo, hi):
                    out.append((t.name, len(t.words), n, placed[a][1], placed[b - 1][2]))
    kept: list[tuple] = []
    for x in sorted(out, key=lambda x: (-x[2], -x[2] / x[1], x[0], x[3])):
        if all(x[4] <= k[3] or k[4] <= x[3] for k in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: x[3])


def license_notices(docs: DataFrame, coverage: float = COVERAGE, texts: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """doc_id, license, template_words, aligned_words, coverage, start_char, end_char of every notice.

    texts: notices by licence with phrases that must stand as they are; NOTICES if not given.
    """
    given = dict(texts or NOTICES)  # the library of notices travels with the task: its size is fixed

    def make():
        library = Library(coverage, given)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = [(d, name, n, k, k / n, a, b) for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for name, n, k, a, b in notices(text or "", library)]
            if not rows:
                return None
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "license", "template_words", "aligned_words", "coverage", "start_char", "end_char"])

        return each

    return arrow_map(only(docs, "doc_id", "text"), make, "doc_id long, license string, template_words long, aligned_words long, coverage double, start_char long, end_char long")
