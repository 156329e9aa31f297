"""Licence scan by Dice coefficient over word bigrams (operator 10).

Text and licence templates are normalised alike: lower case, every run of
characters that are no letter or digit is a separator. A candidate is a run of
words, wherever it begins and ends, also inside a sentence; it matches a template if
``2 * common / (own + template)`` over their sets of word bigrams is at least
``min_dice``. Only runs that begin and end with a bigram of the template are looked
at: without a foreign first or last bigram the coefficient is no lower.

Two exact bounds prune the templates. Size: a match has between
``T * d / (2 - d)`` and ``T * (2 - d) / d`` bigrams for a template of T.
Signature: a match lacks at most ``T - ceil(T * d / (2 - d))`` of the
template's bigrams, so it holds at least one of any that many plus one; the
ones with the fewest common words are looked up for the whole batch at once,
and only texts with such a bigram are looked at further.

The best of all runs is taken first (higher Dice, then more bigrams, then the
earlier, then the licence's name), then the best of those beside it, and so on. Rows are independent: a narrow Arrow map.

Edge cases: a null or empty text has no match; repeated rows each give a row;
repeated notices in a text are each reported; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from prefweave.llm.tables import need
from prefweave.llm.textarrays import chain, chunks, word_hashes

MIN_DICE = 0.8

# Public licence notices, by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
}


def _gnu(name: str, subject: str, version: str) -> str:
    """The notice of the GNU licences, in their own words."""
    return (f"{subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) "
            "any later version.")


TEMPLATES["GPL-2.0"] += (
    _gnu("General Public License", "This program", "2").replace("software:", "software;").replace("either", "; either"),)
TEMPLATES |= {
    "LGPL-2.1": (_gnu("Lesser General Public License", "This library", "2.1"),
                 "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    "LGPL-2.0": (_gnu("Library General Public License", "This library", "2"),
                 "This work is licensed under the GNU Library General Public License, version 2."),
    "LGPL-3.0": (_gnu("Lesser General Public License", "This program", "3"),
                 "This work is licensed under the GNU Lesser General Public License, version 3."),
    "AGPL-3.0": (_gnu("Affero General Public License", "This program", "3"),
                 "This work is licensed under the GNU Affero General Public License, version 3."),
    "BSD-3-Clause": (
        TEMPLATES["BSD-2-Clause"][0] + " 3. Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior written "
        "permission.",),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty.",),
}
COMMON_WORDS = frozenset("a an and any are as at be by for form from if in is it may not of on or software that the this "
                         "to under with you".split())

WORD = re.compile(r"[^\W_]+")


class Template:
    def __init__(self, name: str, text: str, min_dice: float, number: int = 0):
        tokens = WORD.findall(text.lower())
        self.name, self.number = name, number
        self.bigrams = frozenset(zip(tokens, tokens[1:]))
        n = len(self.bigrams)
        self.least = math.ceil(n * min_dice / (2 - min_dice) - 1e-9)
        self.most = math.floor(n * (2 - min_dice) / min_dice + 1e-9)
        rarest = sorted(self.bigrams, key=lambda b: (sum(w in COMMON_WORDS for w in b), -len(b[0]) - len(b[1]), b))
        self.signature = frozenset(rarest[:n - self.least + 1])


def build(templates: Mapping[str, tuple[str, ...]], min_dice: float) -> list[Template]:
    named = [(name, t) for name, texts in templates.items() for t in texts]
    out = [Template(name, t, min_dice, number) for number, (name, t) in enumerate(named)]
    return [t for t in out if t.bigrams]


class Index:
    """The templates by their bigrams, and their signatures."""

    def __init__(self, templates: list[Template]):
        self.of_bigram: dict[tuple[str, str], list[Template]] = {}
        for t in templates:
            for b in t.bigrams:
                self.of_bigram.setdefault(b, []).append(t)
        self.signatures = frozenset().union(*(t.signature for t in templates))
        self.most = max((t.most for t in templates), default=0)


def matches(text: str, index: Index, min_dice: float) -> list[tuple[int, int, str, float]]:
    """(start, end, licence, Dice) of the non-overlapping best runs, by start.

    Starts are taken from right to left. ``nearest`` holds every bigram at or
    after the start, the one that occurs first last, so a run's distinct bigrams
    are read off its end, however often the text repeats itself."""
    spans = [m.span() for m in WORD.finditer(text)]
    tokens = [text[a:b].lower() for a, b in spans]
    nearest: OrderedDict[tuple[str, str], int] = OrderedDict()
    runs, signed = [], False
    for start in range(len(tokens) - 2, -1, -1):
        b = (tokens[start], tokens[start + 1])
        nearest[b] = start
        nearest.move_to_end(b)
        signed = signed or b in index.signatures
        if signed and b in index.of_bigram:
            ahead = list(islice(reversed(nearest.items()), index.most))
            bigrams = {b for b, _ in ahead}
            for t in index.of_bigram[b]:
                if not t.signature.isdisjoint(bigrams):
                    runs.append(_best_run(start, t, ahead, min_dice))
    runs = [r for r in runs if r]
    heapify(runs)
    taken: list[tuple[int, int, str, float]] = []         # word ranges
    while runs:
        dice, _, start, name, end, _, t = heappop(runs)
        i = bisect_right(taken, (start, len(tokens)))
        if i and taken[i - 1][1] > start:
            continue
        if i == len(taken) or end <= taken[i][0]:
            taken.insert(i, (start, end, name, -dice))
        else:                                             # the best that ends before the neighbour
            run = _best_run(start, t, _ahead(tokens, start, taken[i][0], t.most), min_dice)
            if run:
                heappush(runs, run)
    return [(spans[a][0], spans[e - 1][1], name, dice) for a, e, name, dice in taken]


def _ahead(tokens: list[str], start: int, end: int, most: int) -> list[tuple[tuple[str, str], int]]:
    """The first ``most`` distinct bigrams of a range of words and their places."""
    places: dict[tuple[str, str], int] = {}
    for i in range(start, end - 1):
        places.setdefault((tokens[i], tokens[i + 1]), i)
        if len(places) == most:
            break
    return list(places.items())


def _best_run(start: int, t: Template, ahead: list[tuple[tuple[str, str], int]], min_dice: float):
    """The best matching run that begins at word ``start``, as an entry of the heap;
    ``ahead``: its distinct bigrams and their places, in text order."""
    common, best = 0, None
    for own, (b, at) in enumerate(ahead[:t.most], 1):
        if b in t.bigrams:
            common += 1
            dice = 2 * common / (own + len(t.bigrams))
            if own >= t.least and dice >= min_dice and (best is None or (-dice, -own) < best[:2]):
                best = (-dice, -own, start, t.name, at + 2, t.number, t)
    return best


def scan_licenses(documents: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
                  min_dice: float = MIN_DICE) -> DataFrame:
    """One row per document: number of matches, the licences (distinct, by
    name), and ``licence:start:end:dice`` of each match in code points."""
    docs = need(documents, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    compiled = build(templates, min_dice)
    index = Index(compiled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = Lookup(compiled)
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch):
                hits = rare.rows(buf, offs)
                texts = batch.column(1)[lo:hi]
                n, names, spans = [], [], []
                for i, hit in enumerate(hits):
                    got = matches(texts[i].as_py(), index, min_dice) if hit else []
                    n.append(len(got))
                    names.append(",".join(sorted({g[2] for g in got})))
                    spans.append(",".join(f"{name}:{a}:{b}:{d:.4f}" for a, b, name, d in got))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(n, pa.int64()), pa.array(names, pa.string()),
                     pa.array(spans, pa.string())], ["doc_id", "n_matches", "licenses", "spans"])

    return docs.mapInArrow(run, "doc_id bigint, n_matches bigint, licenses string, spans string")


# Bytes for the lookup: all but ASCII letters and digits separate. Templates are
# ASCII, so no two neighbouring template words are missed.
SEPARATED = np.full(256, 0x20, dtype=np.uint8)
for _c in range(128):
    if chr(_c).isalnum():
        SEPARATED[_c] = _c


class Lookup:
    """Which rows of a chunk hold a signature bigram."""

    def __init__(self, templates: list[Template]):
        pairs = [b for t in templates for b in t.signature]
        data = " ".join(w for b in pairs for w in b).encode()
        hashes, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        self.pairs = np.unique(chain([hashes[0::2], hashes[1::2]]))

    def rows(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        hashes, rows = word_hashes(SEPARATED[buf], offs)
        hit = np.zeros(len(offs) - 1, dtype=bool)
        if len(hashes) > 1 and len(self.pairs):
            row = np.repeat(np.arange(len(hit)), np.diff(rows))
            pairs = chain([hashes[:-1], hashes[1:]])
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            good = (self.pairs[at] == pairs) & (row[:-1] == row[1:])
            hit[row[:-1][good]] = True
        return hit
