"""Licence notices found by a trained paragraph classifier and confirmed by their templates.

A paragraph is a line; a long one is read in overlapping pieces of ``PIECE`` words. Notices wrapped over several lines are found in
pieces of the lines up to a blank one, where these name a family that no line of theirs does, or find what no line does. Words (ASCII letters lower-cased, numbers and
versions as they are) and pairs of words are hashed to features. Two logistic regressions are trained on the driver, on
variations of the templates below and on a bounded sample of paragraphs of the documents: one tells notices from other text, and one tells
the families apart, with a class of its own for notices of no known family. The second one's probabilities are calibrated by a
temperature fitted to variations kept out of training, and so is the first one's.

A notice is of the predicted family if the calibrated probability reaches ``SURE`` and it shares enough word pairs with a template
of that family. Templates confirm named families only: what none supports is "unknown" if the calibrated probability that it is a notice
at all reaches ``SURE``, as no named family is left then. Models have a fixed size and are broadcast; documents are scanned whole, without a shuffle.

Defined cases: a null or empty text has no paragraphs; repeated rows are scanned one by one; an empty table gives an empty
result (the templates alone train the models); all columns of the input are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import with_struct
from tidemark.llm.text import Words, byte_set, mix, slices

BUCKETS = 1 << 15
PIECE = 64
SAMPLE_DOCS = 300
VARIATIONS = 24
SURE = 0.6
CONFIRMED = 0.5
SEED = 23
UNKNOWN = "unknown"
#: Letters, digits, bytes beyond ASCII, and what holds versions and names like "CC BY-NC" together is cut.
TERM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

# Usual notices and opening paragraphs of public licences, by family.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0", "This project is licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GNU General Public License version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only", "Released under the GNU LGPL v3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "Released under the GNU AGPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.", "Released under the BSD license.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL": [
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Released under CC BY-NC-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC0": [
        "Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "ISC": [
        "Released under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose.",
    ],
    UNKNOWN: [
        "All rights reserved.", "Copyright 2020 the authors. All rights reserved.", "Licensed under the Custom Public License, version 1.0.", "Released under the Example License.",
        "This material is licensed under the terms of the vendor agreement.", "Use of this software is subject to the licence agreement.", "No part of this publication may be reproduced without permission of the publisher.",
        "Distributed under the Artistic License 2.0.", "Available under the OpenSSL License.", "Available under EPL v2.0.", "Licensed under the Open Data Commons Attribution License.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License.",
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without a written agreement is hereby granted.",
        "The program is provided without warranty of any kind, express or implied, and its authors shall not be liable for any claim or damages.",
        "Modified versions must be marked as changed and must carry prominent notices stating that you changed the original files.",
        "Confidential information of the company. Disclosure, copying or distribution without prior written consent is prohibited.",
        "You may not copy, distribute or create derivative works of this material in any form without the written permission of the owner.",
    ],
}
FAMILIES = [*TEMPLATES]
_SYLLABLES = "ba co du el fi gan hor ist jo ka lum mer nor os pra qui ro sta tu ver".split()
_FILLERS = "see the file for details and more by its authors here notice project code data website work is".split()
_NAMES = "acme zeta foo blue north orion delta river stone vector".split()
#: What makes a notice one of its family; with another name in its place it is a notice of no known family.
_OWN = re.compile(r"GNU (Lesser |Affero )?General|GNU [AL]?GPL|[AL]?GPL|MIT|Apache|BSD|Mozilla|MPL|ISC|Unlicense|CC BY(-[A-Z]+)*|CC-BY(-[A-Z]+)*|CC0|Creative Commons Attribution(-\w+)?")
# Ordinary sentences with the words of notices.
_ORDINARY = [
    "The band released a new album under its old name.", "The second version of the play was shown in spring.", "She was granted permission to leave early.", "You need a driving license to rent a car here.",
    "All children may use the pool free of charge.", "Many copies of the book were sold last year.", "The work of the authors is well known in the country.", "He asked for permission and it was given.",
    "The software was slow and the users were angry.", "See the terms of the contract between the two clubs.", "A file was found in the house of the general.", "The public is welcome and all are free to go.",
    "The film was distributed to cinemas in May.", "The conditions in the city were hard and the roads were closed.", "Version 1.2 of the map shows the new road.", "The third version of the story is the best.",
    "The right of way is on the north side.", "The president was under attack for his use of public money.", "He reserved all the seats for his family.", "The law was changed and the old rules were no longer in use.",
    "The company made the source of the problem known.", "The material is soft and can be cut in any form.", "The material was provided by the state.", "Use a sharp knife and cut the bread.", "The copyright debate went on for years.",
    "Notice the small bird on the left.", "The general public did not like the plan.", "We have no information about the accident.", "The university is available for meetings in summer.", "In no event was he late, as far as we know.",
]


class Pieces:
    """Paragraphs of several texts, long ones in pieces, with their hashed words and pairs of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, joined: bool = False):
        self.words = Words(data, offsets, TERM, lower=True)
        hashes = self.words.hashes()
        n = len(hashes)
        lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
        line = lines[self.words.first]
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.words.offsets))
        new = np.ones(n, bool)
        new[1:] = (line[1:] - line[:-1] > joined) | (doc[1:] != doc[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, n))
        half = PIECE // 2
        count = np.maximum(1, -(-(size - half) // half))
        self.first = np.repeat(start, count) + half * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        self.end = np.minimum(self.first + PIECE, np.repeat(start + size, count))
        if joined:  # lines up to a blank one, but not single lines
            several = line[self.first] != line[self.end - 1]
            self.first, self.end = self.first[several], self.end[several]
        self.doc = doc[self.first] if n else doc
        self.hashes = hashes
        self.lone = (mix(hashes * np.uint64(2) + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)
        pairs = np.roll(hashes, -1) + hashes * np.uint64(0x9E3779B97F4A7C15)
        self.pair_hash = mix(pairs)
        self.pair = (self.pair_hash % np.uint64(BUCKETS)).astype(np.int64)

    def features(self, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(piece, bucket) entries of all pieces or of some, in order."""
        first, end = (self.first, self.end) if some is None else (self.first[some], self.end[some])
        size = end - first
        rows = np.repeat(np.arange(len(first)), size)
        at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        pairs = at + 1 < np.repeat(end, size)
        row = np.concatenate([rows, rows[pairs]])
        bucket = np.concatenate([self.lone[at], self.pair[at[pairs]]])
        by = np.argsort(row, kind="stable")
        return row[by], bucket[by]

    def words_of(self, piece: int) -> np.ndarray:
        return np.unique(self.hashes[self.first[piece]:self.end[piece]])

    def pairs_of(self, piece: int) -> set[int]:
        return set(self.pair_hash[self.first[piece]:self.end[piece] - 1].tolist())


def pieces_of(texts: list[str]) -> Pieces:
    data = [t.replace("\n", " ").encode() for t in texts]
    return Pieces(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


@dataclass
class Models:
    notice: np.ndarray  # weights by bucket, and a bias
    notice_bias: float
    family: np.ndarray  # weights by bucket and family
    family_bias: np.ndarray
    temperature: float
    templates: dict[str, list[set[int]]] = field(default_factory=dict)
    notice_temperature: float = 1.0
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def notices(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        """The calibrated probability that a piece is a notice."""
        size = np.maximum(np.bincount(rows, minlength=n), 1)
        z = np.bincount(rows, self.notice[buckets], minlength=n) / np.sqrt(size) + self.notice_bias
        return 1 / (1 + np.exp(-z / self.notice_temperature))

    def familiar(self, words: np.ndarray) -> bool:
        """Whether half of the distinct words, and two, are words of notices: others only share buckets with them."""
        known = int(np.isin(words, self.words).sum())
        return known >= 2 and 2 * known >= len(words)

    def families(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        size = np.maximum(np.bincount(rows, minlength=n), 1)
        z = np.stack([np.bincount(rows, self.family[buckets, k], minlength=n) for k in range(len(FAMILIES))], 1) / np.sqrt(size)[:, None] + self.family_bias
        return softmax(z / self.temperature)

    def support(self, pairs: set[int], family: str) -> float:
        """Share of common word pairs, of the smaller set, with the nearest template of the family."""
        return max((len(pairs & t) / max(3, min(len(pairs), len(t))) for t in self.templates[family]), default=0.0) if len(pairs) > 1 else 0.0


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def variations(rng: np.random.Generator, template: str, n: int) -> list[str]:
    """The template and texts that differ by version, copyright line, lost words and words around it."""
    out = [template]
    while len(out) < n:
        words = re.sub(r"\d+(\.\d+)?", lambda m: str(rng.integers(1, 5)) + rng.choice([".0", ".1", ""]), template).split()
        words = [w for w in words if len(words) < 6 or rng.random() > 0.06]
        if rng.random() < 0.3:
            words = [*rng.choice(_FILLERS, rng.integers(1, 4)), *words]
        if rng.random() < 0.3:
            words = [*words, *rng.choice(_FILLERS, rng.integers(1, 5))]
        if rng.random() < 0.15:
            words = ["Copyright", "(c)", str(rng.integers(1990, 2027)), rng.choice(_NAMES), *words]
        out.append(" ".join(words))
    return out


def _descend(rows: np.ndarray, buckets: np.ndarray, n: int, target: np.ndarray, weight: np.ndarray, rounds: int = 60, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of target shares (one column per class) by adaptive steps; features are scaled by piece length."""
    kinds = target.shape[1]
    scale = (1 / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1)))[rows]
    used, bucket = np.unique(buckets, return_inverse=True)
    weights, bias = np.zeros((len(used), kinds)), np.zeros(kinds)
    seen, seen_bias = np.full(weights.shape, 1e-8), np.full(kinds, 1e-8)
    for _ in range(rounds):
        z = np.stack([np.bincount(rows, weights[bucket, k] * scale, minlength=n) for k in range(kinds)], 1) + bias
        off = ((softmax(z) if kinds > 1 else 1 / (1 + np.exp(-z))) - target) * weight[:, None]
        slope = np.stack([np.bincount(bucket, off[rows, k] * scale, minlength=len(used)) for k in range(kinds)], 1) + decay * weights
        seen += slope**2
        weights -= 0.5 * slope / np.sqrt(seen)
        seen_bias += off.sum(0) ** 2
        bias -= 0.1 * off.sum(0) / np.sqrt(seen_bias)
    full = np.zeros((BUCKETS, kinds))
    full[used] = weights
    return full, bias


def train(background: list[str]) -> Models:
    """Models from the templates and paragraphs of ordinary text."""
    rng = np.random.default_rng(SEED)
    templates = {f: [pieces_of([t]).pairs_of(0) for t in ts] for f, ts in TEMPLATES.items()}
    known = Models(np.zeros(0), 0.0, np.zeros(0), np.zeros(0), 1.0, templates)
    # Notices among the paragraphs would teach the wrong thing.
    seen = pieces_of(background)
    near = {int(seen.doc[k]) for k in range(len(seen.first)) if max(known.support(seen.pairs_of(k), f) for f in FAMILIES) >= 0.2}
    plain = [t for k, t in enumerate(background) if k not in near]
    notices, labels = [], []
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            texts = variations(rng, template, VARIATIONS)
            notices += texts
            labels += [k] * len(texts)
            if _OWN.search(template):
                for _ in range(VARIATIONS // 4):
                    name = "".join(rng.choice(_SYLLABLES, rng.integers(1, 4))).capitalize()
                    notices += variations(rng, _OWN.sub(name if rng.random() < 0.7 else name[:4].upper(), template), 2)
                    labels += [len(FAMILIES) - 1] * 2
    plain += [" ".join(rng.choice(_FILLERS + _NAMES, rng.integers(3, 20))) for _ in range(100)]
    # Words of notices, alone or out of order, are no notice.
    often = sorted({w for ts in TEMPLATES.values() for t in ts for w in t.split()})
    plain += [x for t in _ORDINARY for x in variations(rng, t, VARIATIONS // 2)]
    for t in _ORDINARY * (VARIATIONS // 4):  # and parts of them, as lines may be
        words = t.rstrip(".").split()
        first = int(rng.integers(0, len(words) - 3))
        plain += variations(rng, " ".join(words[first:first + int(rng.integers(3, 7))]), 2)
    for _ in range(300):
        words = [*rng.choice(often, rng.integers(1, 4)), *rng.choice(_FILLERS + _NAMES, rng.integers(2, 8))]
        plain.append(" ".join(rng.permutation(words)))
    found = pieces_of(notices + plain)
    row, bucket = found.features()
    n = len(found.first)
    is_notice = (found.doc < len(notices)).astype(float)[:, None]
    weight = np.where(is_notice[:, 0] == 1, 0.5 / is_notice.sum(), 0.5 / max(1, n - is_notice.sum()))
    apart = rng.random(n) < 0.2
    notice, notice_bias = _descend(row, bucket, n, is_notice, np.where(apart, 0.0, weight), 100)
    known = Models(notice[:, 0], float(notice_bias[0]), np.zeros(0), np.zeros(0), 1.0, templates)
    losses = []
    for t in np.geomspace(0.1, 4, 25):
        known.notice_temperature = float(t)
        p = known.notices(row, bucket, n)
        likely = np.where(is_notice[:, 0] == 1, p, 1 - p)[apart]
        losses.append((-(np.log(np.maximum(likely, 1e-12)) * weight[apart]).sum(), float(t)))
    notice_temperature = min(losses)[1]

    found = pieces_of(notices)
    row, bucket = found.features()
    n = len(found.first)
    own = np.array(labels)[found.doc]
    target = np.eye(len(FAMILIES))[own]
    held_out = rng.random(n) < 0.2
    share = 1 / np.bincount(own, minlength=len(FAMILIES))[own] / len(FAMILIES)
    family, family_bias = _descend(row, bucket, n, target, np.where(held_out, 0.0, share))
    models = Models(notice[:, 0], float(notice_bias[0]), family, family_bias, 1.0, templates, notice_temperature, np.unique(pieces_of([t for ts in TEMPLATES.values() for t in ts]).hashes))
    losses = []
    for t in np.geomspace(0.1, 4, 25):  # the temperature that makes the kept-out labels likeliest
        models.temperature = float(t)
        p = models.families(row, bucket, n)[held_out, own[held_out]]
        losses.append((-np.log(np.maximum(p, 1e-12)).mean(), float(t)))
    models.temperature = min(losses)[1]
    return models


FIELDS = "n_paragraphs long, families array<string>, notices array<struct<first:long,end:long,family:string,probability:double,support:double>>"
_NOTICES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("support", pa.float64())]))


def scan_pieces(models: Models, found: Pieces, offsets: np.ndarray) -> Iterator[tuple[int, dict]]:
    """The notices among the pieces, each with its text's number."""
    n = len(found.first)
    if not n:
        return
    notice = models.notices(*found.features(), n)
    some = np.flatnonzero(notice > 0.5)
    if not len(some):
        return
    chance = models.families(*found.features(some), len(some))
    for piece, p in zip(some.tolist(), chance):
        pairs = found.pairs_of(piece)
        best = FAMILIES[int(p.argmax())]
        family, probability, support = best, float(p.max()), models.support(pairs, best)
        if best == UNKNOWN or probability < SURE or support < CONFIRMED:
            family, support = UNKNOWN, max(models.support(pairs, f) for f in FAMILIES)
            if support < CONFIRMED:
                probability = float(notice[piece])
                if probability < SURE or not models.familiar(found.words_of(piece)):
                    continue
        doc = int(found.doc[piece])
        first, end = found.words.first[found.first[piece]], found.words.end[found.end[piece] - 1]
        yield doc, {"first": int(first - offsets[doc]), "end": int(end - offsets[doc]), "family": family, "probability": probability, "support": support}


def scan_texts(models: Models, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, list[dict]]]:
    """For each text, its number of paragraphs and the notices in it, with their bytes in the text."""
    found = Pieces(data, offsets)
    counts = np.bincount(found.doc, minlength=len(offsets) - 1) if len(found.first) else np.zeros(len(offsets) - 1, int)
    out: list[tuple[int, list[dict]]] = [(int(c), []) for c in counts]
    for doc, x in scan_pieces(models, found, offsets):
        out[doc][1].append(x)
    wrapped: dict[int, list[dict]] = {}
    for doc, x in scan_pieces(models, Pieces(data, offsets, joined=True), offsets):
        wrapped.setdefault(doc, []).append(x)
    for doc, more in wrapped.items():
        own = out[doc][1]
        for x in more:
            met = [y for y in own if y["first"] < x["end"] and x["first"] < y["end"]]
            if not met or x["family"] != UNKNOWN and all(y["family"] == UNKNOWN for y in met):
                own[:] = [y for y in own if y not in met] + [x]
        own.sort(key=lambda y: y["first"])
    return out


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE_DOCS) -> Models:
    """Models trained with the paragraphs of at most ``sample`` documents, those of the smallest seeded hashes."""
    picked = docs.select(F.xxhash64(F.lit(SEED), F.col(text)).alias("pick")).filter(F.col(text).isNotNull()).distinct().orderBy("pick").limit(sample)
    last = picked.agg(F.max("pick")).first()[0]
    rows = []
    if last is not None:
        near = docs.select(text, F.xxhash64(F.lit(SEED), F.col(text)).alias("pick")).filter((F.col("pick") <= last) & F.col(text).isNotNull())
        rows = near.dropDuplicates(["pick"]).collect()
    return train(sorted(line for r in rows for line in r[0].split("\n")))


def scan_licenses(docs: DataFrame, out: str, text: str = "text", sample: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with a struct ``out``: n_paragraphs, families (distinct, in order) and notices (bytes in the text, family, probability, support)."""
    models = docs.sparkSession.sparkContext.broadcast(fit(docs, text, sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [x for _, data, offsets in slices(batch, text) for x in scan_texts(models.value, data, offsets)]
            yield pa.StructArray.from_arrays([
                pa.array([n for n, _ in found], pa.int64()), pa.array([sorted({x["family"] for x in xs}) for _, xs in found], pa.list_(pa.string())),
                pa.array([xs for _, xs in found], _NOTICES)], names=["n_paragraphs", "families", "notices"])

    return with_struct(docs, out, FIELDS, work)
