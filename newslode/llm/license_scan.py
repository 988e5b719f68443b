"""Licence scans: a trained paragraph classifier, with template comparison as a second opinion.

A paragraph (a line) is the set of its word n-grams, one to three words long,
that training has seen; a logistic regression over them gives each licence family, licences of no
listed family (`unknown`) and paragraphs without a licence (`none`) a probability. Two levels are set by data
held out of training. A paragraph counts as a licence above the first, which few plain paragraphs pass. A licence is given a
family above the second, which few notices of unlisted licences pass; below it is `unknown`. Each licence is
reported; a family is confirmed if of the templates of all families one of its own fits the paragraph best, and well enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, buffer_of, byte_table, spans, text_rows, word_hashes

#: Notices of each family (fixed values: the wording that licences ask for).
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Distributed under the Apache Software License 2.0.",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL v3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "This code is governed by a BSD-style license.",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-nd": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "cc-by-nc-sa": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work, public domain dedication."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GPL v2 or later.",
        "Released under the GPL.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "epl": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
        "Licensed under the EPL 2.0.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "Released under the ISC license.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL v3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction",
        "Licensed under the MIT license.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the MPL 2.0."],
    "reserved": ["All rights reserved.", "Copyright 2020 Example. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher."],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "For more information, please refer to the Unlicense."],
}
#: Names, headings and identifiers of each family, templates as well.
NAMES = {
    "apache": ["Apache License", "Apache License, Version 2.0, January 2004", "Apache 2.0 License", "License: Apache 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "agpl": ["GNU Affero General Public License", "GNU AGPL", "AGPLv3", "License: AGPLv3", "Licensed under the AGPLv3", "SPDX-License-Identifier: AGPL-3.0-or-later", "SPDX-License-Identifier: AGPL-3.0-only"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "The 3-Clause BSD License", "License: BSD", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International", "License: CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International", "License: CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International", "License: CC BY-SA 4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-nc-nd": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International", "SPDX-License-Identifier: CC-BY-NC-ND-4.0"],
    "cc-by-nc-sa": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "SPDX-License-Identifier: CC-BY-NC-SA-4.0"],
    "cc-by-nd": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International", "SPDX-License-Identifier: CC-BY-ND-4.0"],
    "cc0": ["CC0 1.0 Universal", "License: CC0", "SPDX-License-Identifier: CC0-1.0"],
    "gpl": ["GNU General Public License", "GNU General Public License, Version 3, 29 June 2007", "GNU GPL", "GPLv3", "GPLv2", "License: GPLv3", "Licensed under the GPLv3", "Licensed under the GPL", "GPL version 3", "GNU GPL, version 2 or later", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only"],
    "epl": ["Eclipse Public License", "Eclipse Public License - v 2.0", "EPL 2.0", "License: EPL 2.0", "SPDX-License-Identifier: EPL-2.0"],
    "isc": ["ISC License", "The ISC License", "License: ISC", "SPDX-License-Identifier: ISC"],
    "lgpl": ["GNU Lesser General Public License", "GNU LGPL", "LGPLv3", "License: LGPLv3", "Licensed under the LGPLv3", "SPDX-License-Identifier: LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-3.0-only"],
    "mit": ["MIT License", "The MIT License", "License: MIT", "SPDX-License-Identifier: MIT"],
    "mpl": ["Mozilla Public License", "Mozilla Public License Version 2.0", "MPL 2.0", "License: MPL 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": ["The Unlicense", "License: Unlicense", "SPDX-License-Identifier: Unlicense"],
}
TEMPLATES = {k: v + NAMES.get(k, []) for k, v in TEMPLATES.items()}
UNKNOWN, NONE = "unknown", "none"
#: Notices of licences of no listed family; nothing confirms them. Every second one trains the class unknown, the others set the level of a family.
UNLISTED = [
    "Released under the zlib License.", "Licensed under the Artistic License 2.0.",
    "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: Artistic-2.0",
    "Distributed under the Boost Software License, Version 1.0.", "Licensed under the Common Development and Distribution License.",
    "SPDX-License-Identifier: BSL-1.0", "SPDX-License-Identifier: CDDL-1.0",
    "Licensed under the EUPL 1.2.", "Licensed under the Academic Free License version 3.0.",
    "European Union Public License", "Academic Free License",
    "This software is licensed under the terms of the Example Software License.", "Use of this software is governed by the license agreement.",
    "Licensed under the Example Community License Agreement.", "This work is licensed under the Sample Open License.",
    "Licensed under the Example Public License 1.0.", "Distributed under the Sample Public License, version 1.2.",
    "This library is licensed under the Example License.", "This program is licensed under the Sample Licence.",
    "SPDX-License-Identifier: Example-1.0", "SPDX-License-Identifier: Sample-2.0",
    "See the LICENSE file for the license terms.", "See the file COPYING for license terms.",
    "You may use, copy, modify and distribute this software under the following license terms.", "You may copy and distribute this program under the terms of its license.",
    "License: proprietary", "License: other",
    "SPDX-License-Identifier: LicenseRef-Proprietary", "SPDX-License-Identifier: LicenseRef-Internal",
]
#: Paragraphs that speak of licences and grant none (for training).
NEAR_MISSES = [
    "The driver has to show a license to the officer.", "He was released on bail under the terms of the court.", "This work is about the public version of the story.", "All rights come with duties.",
    "The software is free of charge for all students.", "A license was issued to the general store in 2020.", "The library was reserved for all members.", "MIT is a university.", "The Apache helicopter is licensed for export.",
    "The restaurant lost its license to sell wine.", "Drivers renew a license under the new rules.", "The public library is in the general store.", "The general public may visit the house.", "The terms of the agreement were kept secret.",
    "Er kam mit dem Zug und ging mit der Tochter.", "Das Haus mit Garten.", "mit", "Permission was granted by the mayor.", "The right of reply is reserved for members of the house.", "Creative people in common rooms.", "The mozilla fox runs in the wood.", "The version 2.0 of the file is here.",
]
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TABLE = byte_table(SEPARATORS)
#: Documents (about) whose paragraphs train and calibrate the class none; variants of each template; share of paragraphs without a licence that may
#: pass for one, and of unlisted licences that may pass for a family.
TRAIN_DOCS, TRAIN_CHARS, VARIANTS, PASS, MISTAKEN = 400, 20_000, 30, 1e-3, 0.05
#: Of a template's words, the share that has to stand in the paragraph, in order of pairs.
COVER = 0.7
#: From this share on a paragraph is no example of the class none: it may be a notice in other words.
UNSURE = 0.3


def words_of(text: str) -> list[str]:
    low = TABLE[np.frombuffer(text.encode(), np.uint8)] if text else np.zeros(0, np.uint8)
    return bytes(np.where(low == 0, 32, low).astype(np.uint8)).decode(errors="replace").split()


def grams_of(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def variants(texts: list[str], filler: list[str], g: np.random.Generator) -> list[list[str]]:
    """Each text whole, and with words lost (of under five none: one word left alone may be any word), changed years and foreign words around it."""
    out = []
    for t in texts:
        own = words_of(t)
        out.append(own)
        for _ in range(VARIANTS):
            kept = [w for w in own if len(own) < 5 or g.random() > 0.1] or own
            kept = [str(g.integers(1, 30)) if w.isdigit() and g.random() < 0.5 else w for w in kept]
            if filler:
                a, b = g.integers(0, 12, 2)
                kept = [*g.choice(filler, a), *kept, *g.choice(filler, b)]
            out.append(kept)
    return out


class Classifier:
    """Weights of known n-grams for each class, and templates as word pairs."""

    def __init__(self, paragraphs: list[str], seed: int = 5):
        g = np.random.default_rng(seed)
        self.classes = [*sorted(TEMPLATES), UNKNOWN, NONE]
        examples = TEMPLATES | {UNKNOWN: UNLISTED[::2]}
        other = [words_of(p) for p in paragraphs]
        filler = sorted({w for ws in other[:200] for w in ws})[:2000]
        rows = [(ws, k) for k, c in enumerate(self.classes[:-1]) for ws in variants(examples[c], filler, g)]
        known = sorted({x for ws, _ in rows for x in grams_of(ws) if not set(x) & set(filler)} | {x for t in sum(examples.values(), NEAR_MISSES) for x in grams_of(words_of(t))})
        # Paragraphs in which a good part of a template or a notice stands are no examples of the class none.
        self.pairs = {c: [(set(zip(w, w[1:])), set(w)) for w in map(words_of, ts)] for c, ts in examples.items()}
        plain = [ws for ws in other if not any(self.covered(ws, c) >= UNSURE for c in examples)]
        half = len(plain) // 2
        rows += [(ws, len(self.classes) - 1) for ws in plain[:half]] + [(ws, len(self.classes) - 1) for ws in variants(NEAR_MISSES, filler, g)]
        number = {x: i for i, x in enumerate(known)}
        self.grams = known
        lists = [[number[x] for x in grams_of(ws) if x in number] for ws, _ in rows]
        row = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
        col = np.array([i for x in lists for i in x], np.int64)
        y = np.zeros((len(rows), len(self.classes)))
        y[np.arange(len(rows)), [k for _, k in rows]] = 1
        share = 1 / (y.sum(0) * len(self.classes))
        weight = share[y.argmax(1)][:, None]
        w, bias = np.zeros((len(known), len(self.classes))), np.zeros(len(self.classes))
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(bias), np.zeros_like(bias)
        for t in range(1, 201):
            z = np.stack([np.bincount(row, w[col, k], len(rows)) for k in range(len(self.classes))], 1) + bias
            p = np.exp(z - z.max(1, keepdims=True))
            d = weight * (p / p.sum(1, keepdims=True) - y)
            grad = np.stack([np.bincount(col, d[row, k], len(known)) for k in range(len(self.classes))], 1) + 1e-5 * w
            gb = d.sum(0)
            m, v, mb, vb = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
            w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            bias -= 0.05 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
        self.w, self.bias = w, bias
        # What all but a share PASS of the plain paragraphs held out stay below, and what new variants of all notices reach: the level lies between.
        licence = lambda lists: np.array([1 - self.one(ws)[-1] for ws in lists])
        plain_reach = float(np.quantile(licence(plain[half:]), 1 - PASS)) if plain[half:] else 0.0
        notices = [ws for c in TEMPLATES for ws in variants(TEMPLATES[c], filler, g)[:: VARIANTS // 2]]
        self.level = (plain_reach + max(plain_reach, float(np.quantile(licence(notices), 0.01)))) / 2
        # What all but a share MISTAKEN of the unlisted notices held out stay below: the surest family's share of the licence.
        shares = [p[:-2].max() / max(1e-9, 1 - p[-1]) for p in map(self.one, variants(UNLISTED[1::2], filler, g)) if 1 - p[-1] >= self.level]
        self.sure = float(np.quantile(shares, 1 - MISTAKEN)) if shares else 0.5
        self.lookup()

    def one(self, words: list[str]) -> np.ndarray:
        number = {x: i for i, x in enumerate(self.grams)} if not hasattr(self, "number") else self.number
        self.number = number
        z = self.bias + self.w[[number[x] for x in grams_of(words) if x in number]].sum(0)
        p = np.exp(z - z.max())
        return p / p.sum()

    def covered(self, words: list[str], family: str) -> float:
        """The largest share of a template's word pairs (of its word, if it has but one) that stand in the paragraph."""
        return max((share for share, _ in self.fits(words, family)), default=0.0)

    def confirmed(self, words: list[str], family: str) -> bool:
        """The family's best template covers its words well, and no other family's that does so matches more of the paragraph."""
        best = {c: max(((matched, share) for share, matched in self.fits(words, c) if share >= COVER), default=None) for c in TEMPLATES}
        mine = best.pop(family)
        return mine is not None and mine >= max(filter(None, best.values()), default=mine)

    def fits(self, words: list[str], family: str) -> list[tuple[float, int]]:
        """Of each template of a family the share, and the number, of its word pairs in the paragraph."""
        own, single = set(zip(words, words[1:])), set(words)
        return [(len(own & t) / len(t), len(own & t)) if t else (float(w <= single), int(w <= single)) for t, w in self.pairs[family]]

    def judge(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows of probabilities the class of each, and the probability of it: a licence below the level is none, a family that isn't sure is unknown."""
        licence = 1 - p[:, -1]
        kind, best = p[:, :-2].argmax(1), p[:, :-2].max(1)
        sure = (best >= p[:, -2]) & (best >= self.sure * licence)
        kind = np.where(licence < self.level, len(self.classes) - 1, np.where(sure, kind, len(self.classes) - 2))
        return kind, np.where(licence < self.level, p[:, -1], np.where(sure, best, licence))

    def lookup(self) -> None:
        """Sorted tables for whole batches: words by hash, pairs and triples of them by number."""
        vocabulary = sorted({w for x in self.grams for w in x})
        number = {w: i for i, w in enumerate(vocabulary, 1)}
        buf = np.frombuffer("".join(vocabulary).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in vocabulary])
        h = word_hashes(buf, ends - [len(w.encode()) for w in vocabulary], ends)
        order = np.argsort(h)
        self.hash, self.word = h[order], (order + 1).astype(np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[h >> np.uint64(44)] = True
        base = len(vocabulary) + 1
        code = lambda x: sum(number[w] * base**i for i, w in enumerate(x))
        codes = np.array([code(x) for x in self.grams], np.int64)
        at = np.argsort(codes)
        self.base, self.codes, self.row = base, codes[at], at

    def rows(self, code: np.ndarray) -> np.ndarray:
        """Row of each n-gram's weights, -1 for one never seen."""
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[place] == code, self.row[place], -1)

    def probabilities(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
        h = word_hashes(low, start, end)
        sym = np.zeros(len(h), np.int64)
        at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.hash, h[at]), len(self.hash) - 1)
        sym[at] = np.where(self.hash[place] == h[at], self.word[place], 0)
        found = []
        for n in (1, 2, 3):
            if len(sym) < n:
                continue
            last = len(sym) - n + 1
            ok = (line[:last] == line[n - 1 :]) & np.logical_and.reduce([sym[i : last + i] > 0 for i in range(n)])
            own = np.flatnonzero(ok)
            row = self.rows(sum(sym[own + i] * self.base**i for i in range(n)))
            found.append(np.stack([line[own][row >= 0], row[row >= 0]], 1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        z = np.stack([np.bincount(pairs[:, 0], self.w[pairs[:, 1], k], lines) for k in range(len(self.classes))], 1) + self.bias
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def sample_paragraphs(docs: DataFrame, most: int = TRAIN_DOCS) -> list[str]:
    """Lines of about `most` documents of no more than TRAIN_CHARS characters, drawn by a hash: a bounded sample."""
    total = docs.count()
    own = text_rows(docs).where(F.length("text") <= TRAIN_CHARS).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30) * F.lit(total) < most)
    return sorted(x for r in own.select("text").limit(2 * most).collect() for x in set(r.text.split("\n")))


SCAN = "doc_id long, n_paragraphs long, n_licensed long, family string, families string, score double, confirmed boolean"


def scan(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, n_paragraphs, n_licensed, family (of the surest paragraph, confirmed ones first, `none` without one), families (all, sorted,
    joined by commas), score (of that paragraph), confirmed (a template confirms it), for each row of docs. Family `unknown`, which
    nothing confirms, is a licence of no listed family.

    Score is the probability of the family, and of any licence for `unknown`. Null and empty texts are one empty paragraph without a licence; ties go to the first family by name, then the first paragraph.
    """
    model = docs.sparkSession.sparkContext.broadcast(Classifier(sample_paragraphs(docs, train_docs)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = model.value
        for b in batches(it):
            data, offsets = buffer_of(b.column("text"))
            low = TABLE[data]
            breaks = np.flatnonzero(data == 10)
            line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
            line_end = np.sort(np.concatenate([breaks, offsets[1:]]))
            per_doc = 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
            doc_of = np.repeat(np.arange(b.num_rows), per_doc)
            start, end = spans(low, offsets)
            line = np.searchsorted(line_start, start, side="right") - 1 if len(start) else np.zeros(0, np.int64)
            p = c.probabilities(low, start, end, line, len(line_start))
            kind, best = c.judge(p)
            hit = np.flatnonzero(kind < len(c.classes) - 1)
            held: dict[int, list] = {}
            for i in hit.tolist():
                words = words_of(bytes(data[line_start[i] : line_end[i]]).decode(errors="replace"))
                family = c.classes[kind[i]]
                confirmed = family != UNKNOWN and c.confirmed(words, family)
                held.setdefault(int(doc_of[i]), []).append((-round(float(best[i]), 9), family, confirmed))
            out: tuple[list, ...] = ([], [], [], [], [])
            for d in range(b.num_rows):
                found = sorted(held.get(d, []), key=lambda x: (not x[2], x[0], x[1]))
                top = found[0] if found else (0.0, NONE, False)
                for col, x in zip(out, (len(found), top[1], ",".join(sorted({x[1] for x in found})), -top[0], top[2]), strict=True):
                    col.append(x)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(per_doc.astype(np.int64)), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], names=["doc_id", "n_paragraphs", "n_licensed", "family", "families", "score", "confirmed"])

    return text_rows(docs).mapInArrow(run, SCAN)
