"""Licence scans: a trained paragraph classifier over word n-grams, confirmed by template comparison.

A paragraph is a run of lines without a line between them that has no words, so a notice may be wrapped, and a comment's marks
count for nothing. Within a paragraph, a stretch is a run of words in which the templates' bigrams come at most GAP words
apart; what is around a notice in a long paragraph is left out with that. Multinomial logistic regression with an L1 penalty
on word unigrams and bigrams of the templates below learns the licence families against an unknown class, which learns
from stretches of the corpus and from scrambled templates. A temperature fitted on examples that were left out calibrates
the probabilities. A predicted family stands where a template of it shares enough of its bigrams with the stretch.
Words are runs of ASCII letters, digits and all bytes outside ASCII, with A-Z lower-cased.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import Words, _mix, drawn, sliced, utf8

_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
#: Notices of licence families, each a template.
NOTICES = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ),
    "apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "bsl": ('Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software', "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt"),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released under CC0 1.0 Universal Public Domain Dedication."),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/"),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc.",
        "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    ),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        _WARRANTY,
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "reserved": ("All rights reserved.",),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
}
#: Names of licences as they stand after "licensed under", and their identifiers. {v}: one of VERSIONS, {s}: one of SUFFIXES.
NAMES = {
    "agpl": (("the GNU Affero General Public License version {v}", "the AGPL v{v}"), ("AGPL-{v}.0{s}",)),
    "apache": (("the Apache License Version 2.0", "the Apache 2.0 license"), ("Apache-2.0",)),
    "bsd": (("the BSD 3-Clause License", "the BSD 2-Clause License", "the BSD license"), ("BSD-2-Clause", "BSD-3-Clause", "0BSD")),
    "bsl": (("the Boost Software License Version 1.0",), ("BSL-1.0",)),
    "cc0": (("CC0 1.0 Universal",), ("CC0-1.0",)),
    "cc-by": (("CC BY 4.0",), ("CC-BY-4.0", "CC-BY-3.0")),
    "cc-by-nc": (("CC BY-NC 4.0",), ("CC-BY-NC-4.0",)),
    "cc-by-sa": (("CC BY-SA 4.0",), ("CC-BY-SA-4.0", "CC-BY-SA-3.0")),
    "gpl": (("the GNU General Public License version {v}", "the GNU GPL v{v}", "the GPLv{v}"), ("GPL-{v}.0{s}",)),
    "isc": (("the ISC License",), ("ISC",)),
    "lgpl": (("the GNU Lesser General Public License version {v}", "the GNU Lesser General Public License version 2.1", "the LGPL v{v}"), ("LGPL-{v}.0{s}", "LGPL-2.1{s}")),
    "mit": (("the MIT License",), ("MIT",)),
    "mpl": (("the Mozilla Public License version 2.0",), ("MPL-2.0",)),
    "unlicense": (("the Unlicense",), ("Unlicense",)),
    "zlib": (("the zlib License",), ("Zlib",)),
}
VERBS, VERSIONS, SUFFIXES = ("Licensed under", "Released under", "Distributed under", "is licensed under"), ("1", "2", "3"), ("", "-only", "-or-later", "+")
FAMILIES = ("unknown", *NOTICES)
SAMPLE, SAMPLE_STRETCHES = 2000, 3000  # documents whose stretches teach the unknown class, about; stretches at most
GAP = 6  # words from one bigram of the templates to the next in a stretch at most
SURE = 0.3  # calibrated probability of a family at least
SHARED, SHORT, LONG = 0.6, 3, 15  # of the bigrams of a template with LONG or more at least; all of SHORT, and between them in between
COPIES, EACH = 6, 120  # examples of each template, and of each family at least
ROUNDS, STEP, L1 = 120, 1.0, 3e-5
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def templates() -> list[tuple[int, str]]:
    """(family's number, text) of all templates: the notices, and names and identifiers with their verbs, versions and suffixes."""
    out = [(f, x) for f, texts in NOTICES.items() for x in texts]
    for f, (names, marks) in NAMES.items():
        filled = lambda x: dict.fromkeys(x.replace("{v}", v).replace("{s}", s) for v in VERSIONS for s in SUFFIXES)
        out += [(f, f"{verb} {y}") for x in names for y in filled(x) for verb in VERBS]
        out += [(f, f"SPDX-License-Identifier: {y}") for x in marks for y in filled(x)]
    return [(FAMILIES.index(f), x) for f, x in out]


class Grams:
    """Words of a batch of texts: hashes, line (from the text's first), text, and whether a word and the next are one paragraph."""

    def __init__(self, column):
        raw, off = utf8(column)
        words = Words(column, _BREAK)
        self.h = words.hashes()
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(words.of))
        lines = np.r_[0, np.cumsum(raw == 10)]
        self.line = lines[words.begin] - lines[off[self.text]]
        self.pair = _mix(self.h[:-1] * np.uint64(3) + self.h[1:] * np.uint64(5))
        self.inside = (self.text[1:] == self.text[:-1]) & (self.line[1:] - self.line[:-1] < 2)


def _in(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether x are among the sorted known; most aren't, and their low bits tell."""
    if not len(known):
        return np.zeros(len(x), bool)
    some = np.zeros(1 << 16, bool)
    some[known & np.uint64(0xFFFF)] = True
    out = some[x & np.uint64(0xFFFF)]
    near = np.flatnonzero(out)
    out[near] = known[np.minimum(np.searchsorted(known, x[near]), len(known) - 1)] == x[near]
    return out


class Vocabulary:
    """All n-grams of the templates, sorted; their bigrams; of each template its family's number and its bigrams' places."""

    def __init__(self):
        texts = templates()
        g = Grams(pa.array([x for _, x in texts]))
        self.pairs = np.unique(g.pair[g.inside])
        self.known = np.unique(np.r_[g.h, self.pairs])
        of = g.text[:-1][g.inside]
        self.templates = [(f, np.unique(np.searchsorted(self.known, g.pair[g.inside][of == i]))) for i, (f, _) in enumerate(texts)]
        self.by_family = {k: [x for f, x in self.templates if f == k and len(x)] for k in range(len(FAMILIES))}

    def stretches(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a batch of texts, by stretch: text and line; and stretch and place in the vocabulary of each n-gram, once a stretch."""
        g = Grams(column)
        hit = np.flatnonzero(g.inside & _in(self.pairs, g.pair)) if len(g.h) else np.zeros(0, np.int64)
        if not len(hit):
            return hit, hit, hit, hit
        para = np.r_[0, np.cumsum(~g.inside)]
        new = np.r_[True, (np.diff(hit) > GAP) | (para[hit[1:]] != para[hit[:-1]])]
        begin, end = hit[new], hit[np.r_[np.flatnonzero(new)[1:] - 1, len(hit) - 1]] + 2
        size = end - begin
        word = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        of = np.repeat(np.arange(len(begin)), size)
        two = np.r_[of[1:] == of[:-1], False]
        gram, of = np.r_[g.h[word], g.pair[word[two]]], np.r_[of, of[two]]
        some = _in(self.known, gram)
        both = np.unique(of[some] * len(self.known) + np.searchsorted(self.known, gram[some]))
        return g.text[begin], g.line[begin], both // len(self.known), both % len(self.known)

    def share(self, family: int, places: np.ndarray) -> float:
        """Of the bigrams of the template of a family that shares most, the part that is in places (sorted)."""
        return max((np.isin(x, places, assume_unique=True).mean() for x in self.by_family[family]), default=0.0)

    def confirmed(self, family: int, places: np.ndarray) -> bool:
        """Whether places have enough of the bigrams of a template of the family."""
        need = lambda n: 1 - (1 - SHARED) * min(1.0, max(0.0, (n - SHORT) / (LONG - SHORT)))
        return any(np.isin(x, places, assume_unique=True).mean() >= need(len(x)) for x in self.by_family[family])


def _groups(of: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(at, np.searchsorted(of, np.arange(1, n)))


def _unknown(vocabulary):
    def stretches(batches):
        for batch in sliced(batches):
            text, _, of, at = vocabulary.value.stretches(batch.column("text"))
            draw = batch.column("draw").to_numpy()[text] if len(text) else text
            yield pa.RecordBatch.from_arrays([pa.array(draw), pa.array(_groups(of, at, len(text)) if len(text) else [], pa.list_(pa.int64()))], ["draw", "places"])

    return stretches


def train(unknown: list[list[int]], v: Vocabulary, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (n-grams x families), intercepts and temperature. Stretches that match a template by its bigrams teach no unknown.

    A template is learned whole, with words left out or changed, cut short, and among words of another template; its words
    without their order are unknown.
    """
    rng = np.random.default_rng(seed)
    texts = [(f, x.split()) for f, x in templates()]
    many = np.bincount([f for f, _ in texts], minlength=len(FAMILIES))
    made, kinds = [], []
    for f, words in texts:
        for c in range(max(COPIES, EACH // many[f])):
            kept = [w if rng.random() > 0.04 * (c % 3) else "other" for w in words if rng.random() > 0.06 * (c % 3)] or words
            made.append(" ".join(kept[: max(6, len(kept) * 2 // 3)] if c % 3 == 2 else kept))
            kinds.append(f)
        for _ in range(COPIES // 3):
            made.append(" ".join(rng.permutation(words)[: max(2, len(words) // 2)]))
            kinds.append(0)
    text, _, of, at = v.stretches(pa.array(made))
    rows, y = [], []
    for i, r in zip(text.tolist(), _groups(of, at, len(text))):
        rows.append(r)
        y.append(kinds[i])
    for x in unknown:
        mine = np.array(x, np.int64)
        if not any(v.confirmed(k, mine) for k in range(1, len(FAMILIES))):
            rows.append(mine)
            y.append(0)
    x, y = np.zeros((len(rows), len(v.known)), np.float32), np.array(y)
    for i, r in enumerate(rows):
        x[i, r] = 1
    left = np.arange(len(rows)) % 5 == 4
    k = len(FAMILIES)
    w, b = np.zeros((len(v.known), k), np.float32), np.zeros(k, np.float32)
    fit, want, step = x[~left], np.eye(k, dtype=np.float32)[y[~left]], STEP
    for _ in range(ROUNDS):
        z = fit @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - want) / len(fit)
        w -= step * (fit.T @ error)
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b -= step * error.sum(0)
    z = x[left] @ w + b

    def loss(t: float) -> float:
        q = z / t - (z / t).max(1, keepdims=True)
        return float((np.log(np.exp(q).sum(1)) - q[np.arange(len(q)), y[left]]).sum())

    return w, b, float(min(np.exp(np.linspace(np.log(0.05), np.log(10), 60)), key=loss))


def _classified(model):
    def classify(batches):
        v, w, b, t = model.value
        for batch in sliced(batches):
            text, line, of, at = v.stretches(batch.column("text"))
            out: list[list] = [[] for _ in range(batch.num_rows)]
            if len(text):
                starts = np.searchsorted(of, np.arange(len(text)))
                z = (np.add.reduceat(w[at], starts, axis=0) + b) / t
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                ends = np.r_[starts[1:], len(at)]
                for i, f in zip(*np.nonzero(p[:, 1:] >= SURE)):
                    if v.confirmed(f + 1, at[starts[i] : ends[i]]):
                        out[text[i]].append((int(line[i]), FAMILIES[f + 1], float(p[i, f + 1])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in out], pa.int64()), pa.array([",".join(sorted({f for _, f, _ in x})) for x in out]), pa.array([",".join(f"{f}:{line}" for line, f, _ in x) for x in out]), pa.array([max((q for _, _, q in x), default=0.0) for x in out])],
                ["doc_id", "n_notices", "families", "notices", "score"],
            )

    return classify


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_notices, families, notices (family:line where its stretch begins, from 0), score of every row of docs(doc_id, text).

    Null and empty texts have none. Repeated rows say the same. Other columns are ignored. An empty table gives no rows. A
    stretch may have notices of several families.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    v = Vocabulary()
    found = drawn(rows, rows.count(), SAMPLE).select("draw", "text").mapInArrow(_unknown(spark.sparkContext.broadcast(v)), "draw long, places array<long>")
    found = found.groupBy("places").agg(F.min("draw").alias("draw")).orderBy("draw", "places").limit(SAMPLE_STRETCHES).collect()
    model = spark.sparkContext.broadcast((v, *train([r.places for r in found], v)))
    return rows.mapInArrow(_classified(model), "doc_id long, n_notices long, families string, notices string, score double")
