"""Licence scans: a trained paragraph classifier names licence families, and templates confirm it."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import U64, frugal, hash_words, slices, trim, windows

#: Names of each family. Notices are made from these and PATTERNS.
FAMILIES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "Affero General Public License", "AGPL-3.0", "AGPLv3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License", "Apache-2.0", "Apache Software License 2.0"),
    "BSD": ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause"),
    "CC-BY": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "CC BY 3.0"),
    "CC-BY-NC": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0", "CC BY-NC-SA 4.0"),
    "CC-BY-ND": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC-BY-ND-4.0"),
    "CC-BY-SA": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", "CC BY-SA 3.0"),
    "CC0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "CC0-1.0"),
    "EPL": ("Eclipse Public License", "Eclipse Public License 2.0", "EPL-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0", "GPLv3"),
    "ISC": ("ISC License", "ISC"),
    "LGPL": ("GNU Lesser General Public License", "GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv2.1"),
    "MIT": ("MIT License", "MIT Licence", "MIT", "Expat License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License", "MPL-2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense", "The Unlicense"),
}
#: Sentences that notices and their like are made of.
PATTERNS = (
    "Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "This work is licensed under the {}.",
    "This work is licensed under a {}.", "This software is distributed under the terms of the {}.", "SPDX-License-Identifier: {}",
    "You may use this file under the {}.", "See the {} for details.", "Available under the {} terms.", "License: {}",
    "This program is free software: you can redistribute it under the terms of the {}.", "Copyright (c) the authors. {}.",
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free "
    "Software Foundation, either version {1} of the License, or (at your option) any later version.",
    "You should have received a copy of the {0} along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details.",
)
#: Paragraphs of licence texts, and of the headers that licences ask for.
BODIES = {
    "AGPL-3.0": tuple(t.format("GNU Affero General Public License", 3) for t in _GNU),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        "language governing permissions and limitations under the License.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "EPL": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "GPL-2.0": (_GNU[0].format("GNU General Public License", 2),),
    "GPL-3.0": (_GNU[0].format("GNU General Public License", 3),),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "LGPL": tuple(t.format("GNU Lesser General Public License", 3) for t in _GNU) + (_GNU[0].format("GNU Lesser General Public License", 2.1),),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}
#: Neighbouring lines that are also read as one paragraph, besides whole blocks between blank lines.
JOINED = (3, 2)
#: Word pairs of a notice that may be spread over a whole block.
LEAST_BLOCK = 10
#: Sentences with the same words that name no family.
OTHERS = (
    "Please renew your driving licence before version 3 of the form.", "The license plate of the car was never found.",
    "A public version of the report is available under the bridge.", "The apache helicopter landed near the creative commons.",
    "Students at mit released a general study.", "Fishing license fees are due in the first week.", "All rights of the public were reserved.",
    "International attribution of the work is under review.", "The mozilla browser and the eclipse were seen.",
    "We joined MIT. Copyright (c) the authors.", "Copyright (c) the authors.", "Copyright 2020 Example Inc. All rights reserved.", "She studied at MIT and wrote for BSD systems.",
    "The ISC met in May.", "CC the team on it.", "GNU and Apache were discussed.", "This license is not ours.", "Permission was granted free of charge.", "Copyright law is a matter of general interest.", "See the manual for details.", "This work is under way.", "Released in version 2.0 of the catalogue.",
)
#: Altered copies of each body paragraph among the examples.
BODY_COPIES = 12
MADE_UP = ("Foxglove", "Harbour", "Blue River", "Northern", "Example", "Acme Internal", "Company", "Custom", "Private")
#: Documents whose paragraphs serve as examples of no licence at most, first by md5(doc_id).
NEGATIVE_DOCS = 200
#: Longest text among them, so that what the driver gets is bounded.
NEGATIVE_BYTES = 1 << 16
BUCKETS = 1 << 20
LEAST_PROBABILITY = 0.5
#: Part of a notice's word pairs that a paragraph must have to be confirmed.
LEAST_SHARED = 0.75


class Paragraphs(NamedTuple):
    """Words of paragraphs (lines): paragraph p has offsets[p]:offsets[p + 1], and belongs to text doc[p]."""

    codes: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    lines: np.ndarray  # paragraphs with a word, by text
    apart: np.ndarray  # the paragraph is the first of its text or comes after a blank line


def paragraphs(col: pa.Array) -> Paragraphs:
    words = hash_words(col, lower=True)
    n_docs = len(words.offsets) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(words.offsets))
    if not len(doc):
        return Paragraphs(words.hashes, np.zeros(1, np.int64), doc, np.zeros(n_docs, np.int64), np.zeros(0, bool))
    breaks = np.r_[0, np.cumsum(words.buf == 0x0A)]
    full, starts, _, codes = trim(words)
    doc = doc[full]
    new = np.ones(len(codes), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (breaks[starts[1:]] != breaks[starts[:-1]])
    first = np.flatnonzero(new)
    line = breaks[words.starts]  # of every word, those of punctuation only too: a line of them is not blank
    gap = np.r_[True, np.diff(line) > 1]
    gaps = np.cumsum(gap)[full][first]
    apart = np.r_[True, (gaps[1:] != gaps[:-1]) | (doc[first][1:] != doc[first][:-1])][: len(first)]
    return Paragraphs(codes, np.r_[first, len(codes)], doc[first], np.bincount(doc[first], minlength=n_docs), apart)


def grams(p: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, bucket) of its 1-, 2- and 3-word n-grams."""
    where = np.repeat(np.arange(len(p.offsets) - 1), np.diff(p.offsets))
    ends = np.repeat(p.offsets[1:], np.diff(p.offsets))
    rows, feature = [], []
    for k in (1, 2, 3):
        h = windows(p.codes, k)
        fine = np.arange(len(h)) + k <= ends[: len(h)]
        rows.append(where[: len(h)][fine])
        feature.append((h[fine] % U64(BUCKETS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(feature)


class Model(NamedTuple):
    number: np.ndarray  # bucket -> row of weights, or -1
    weights: np.ndarray  # (features, classes); class 0 is unknown
    bias: np.ndarray
    temperature: float


def notices(rng: np.random.Generator) -> tuple[list[str], list[int]]:
    """Examples: every family's notices, whole and with words beside or missing, and sentences that name none (class 0)."""
    texts, labels = [], []
    fill = ["lorem", "item", "data", "note", "project", "code", "files", "text", "here", "page", "our", "new"]
    add = lambda t, y: (texts.append(t), labels.append(y))
    for y, names in enumerate(FAMILIES.values(), 1):
        for name in names:
            for pattern in PATTERNS:
                whole = pattern.format(name)
                add(whole, y)
                beside = " ".join(rng.choice(fill, rng.integers(1, 12)))
                add(f"{beside} {whole}" if rng.random() < 0.5 else f"{whole} {beside}", y)
    for y, family in enumerate(FAMILIES, 1):
        for body in BODIES.get(family, ()):
            words = body.split()
            add(body, y)
            for _ in range(BODY_COPIES):
                beside = rng.choice(fill, rng.integers(0, 12)).tolist()
                kept = [w for w in words if rng.random() > 0.08]
                add(" ".join(beside + kept if rng.random() < 0.5 else kept + beside), y)
    for pattern in PATTERNS:
        for name in MADE_UP:
            add(pattern.format(f"{name} License" if rng.random() < 0.7 else f"{name} Terms, version {rng.integers(1, 5)}"), 0)
    for other in OTHERS * 12:
        words = [w for w in other.split() if rng.random() > 0.1]
        add(" ".join([*rng.choice(fill, rng.integers(0, 6)), *words]), 0)
    return texts, labels


def fit(negatives: list[str], rounds: int = 200, l1: float = 2e-4, seed: int = 5) -> Model:
    """Multinomial logistic regression with an L1 penalty by accelerated proximal steps, on n-grams of the notices; the
    temperature that fits a held-out fifth best calibrates the probabilities, that of unknown among them."""
    rng = np.random.default_rng(seed)
    texts, labels = notices(rng)
    known = np.unique(grams(paragraphs(pa.array(texts)))[1])
    texts, y = texts + negatives, np.array(labels + [0] * len(negatives))
    number = np.full(BUCKETS, -1, np.int32)
    number[known] = np.arange(len(known))
    p = paragraphs(pa.array([t.replace("\n", " ") for t in texts]))
    row, feature = grams(p)
    hit = number[feature] >= 0
    row, feature = p.doc[row[hit]], number[feature[hit]].astype(np.int64)
    row, feature = np.divmod(np.unique(row * len(known) + feature), len(known))  # each n-gram counts once
    hold = rng.random(len(texts)) < 0.2
    n_classes = len(FAMILIES) + 1
    weights, bias = np.zeros((len(known), n_classes)), np.zeros(n_classes)
    ahead, ahead_b, t, rate = weights, bias, 1.0, 0.5
    # equal examples are one with a weight
    cuts = np.searchsorted(row, np.arange(len(texts) + 1))
    same: dict[tuple[bytes, int], int] = {}
    for i in np.flatnonzero(~hold).tolist():
        key = feature[cuts[i] : cuts[i + 1]].tobytes(), int(y[i])
        same[key] = same.get(key, 0) + 1
    lists = [np.frombuffer(f, np.int64) for f, _ in same]
    own, at = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    one = np.eye(n_classes)[[c for _, c in same]]
    times = np.array(list(same.values()))[:, None] / sum(same.values())

    def added(where: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(where, weights=values[:, c], minlength=n) for c in range(n_classes)], axis=1)

    for _ in range(rounds):
        d = (_softmax(added(at, ahead[own], len(lists)) + ahead_b) - one) * times
        new = ahead - rate * added(own, d[at], len(known))
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_b = ahead_b - rate * d.sum(axis=0)
        step = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = new + (t - 1) / step * (new - weights), new_b + (t - 1) / step * (new_b - bias)
        weights, bias, t = new, new_b, step
    raw = added(row, weights[feature], len(texts))[hold] + bias
    loss = lambda temp: -np.log(_softmax(raw / temp)[np.arange(len(raw)), y[hold]] + 1e-12).mean()
    used = np.flatnonzero(np.abs(weights).sum(axis=1) > 0)
    number = np.full(BUCKETS, -1, np.int32)
    number[known[used]] = np.arange(len(used))
    return Model(number, weights[used], bias, min(np.geomspace(0.1, 4, 25), key=loss))


#: Models of this process by a hash of their negative examples: the same sample gives the same model.
_FITTED: dict[str, Model] = {}


def negatives(texts: list[str | None]) -> list[str]:
    """Lines of texts that serve as examples of no licence: those without the words of notices, of whose word pairs at most
    three tenths are in some notice or body paragraph."""
    lines = [line for t in texts for line in (t or "").split("\n") if line.split() and not any(w in line.lower() for w in ("licen", "copyright", "spdx", "cc by", "cc0"))]
    known = set().union(*(t.pairs for own in templates() for t in own))
    p = paragraphs(pa.array(lines, pa.string()))
    sure = {int(d) for d, a, b in zip(p.doc, p.offsets[:-1], p.offsets[1:], strict=True) if 10 * len((own := _pairs(p.codes[a:b])) & known) <= 3 * len(own)}
    return [line for d, line in enumerate(lines) if d in sure]


def fitted(negatives: list[str]) -> Model:
    key = hashlib.md5("\n".join(negatives).encode()).hexdigest()
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = fit(negatives)
    return _FITTED[key]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _pairs(codes: np.ndarray) -> set[int]:
    return set(windows(codes, 2).tolist()) or set(codes.tolist())


class Notice(NamedTuple):
    """Word pairs of a notice or body paragraph, and those that name the family: within its name, and from the word before."""

    pairs: set[int]
    must: set[int]


def templates() -> list[list[Notice]]:
    """Notices and body paragraphs of each family, by class."""
    count = lambda text: len(paragraphs(pa.array([text])).codes)
    out: list[list[Notice]] = [[]]
    for family, names in FAMILIES.items():
        own = []
        for name in names:
            for pattern in PATTERNS:
                codes = paragraphs(pa.array([pattern.format(name)])).codes
                before = count(pattern.split("{}")[0])
                own.append(Notice(_pairs(codes), set(windows(codes, 2)[max(0, before - 1) : before + count(name) - 1].tolist())))
        p = paragraphs(pa.array(BODIES.get(family, ()), pa.string()))
        own += [Notice(_pairs(p.codes[a:b]), set()) for a, b in zip(p.offsets[:-1], p.offsets[1:], strict=True)] if len(p.codes) else []
        out.append(own)
    return out


def _hits(p: Paragraphs, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the first word, words, row of weights) of the n-grams that have weights, across lines too."""
    at, size, row = [], [], []
    for k in (1, 2, 3):
        own = number[(windows(p.codes, k) % U64(BUCKETS)).astype(np.int64)]
        hit = np.flatnonzero(own >= 0)
        at.append(hit)
        size.append(np.full(len(hit), k))
        row.append(own[hit])
    return np.concatenate(at), np.concatenate(size), np.concatenate(row)


def _units(p: Paragraphs):
    """(fewest word pairs of a notice that confirms, first lines, lines behind) of what is read as one paragraph: each line,
    blocks of many lines, and JOINED neighbouring lines of a block. Of each triple, no two overlap."""
    n = len(p.doc)
    line = np.arange(n)
    yield 0, line, line + 1
    starts = np.flatnonzero(p.apart)
    stops = np.r_[starts[1:], n][: len(starts)]
    stop = np.repeat(stops, stops - starts)
    more = stops - starts > max(JOINED)
    yield LEAST_BLOCK, starts[more], stops[more]
    place = line - np.searchsorted(p.doc, p.doc)  # within the text, so that a text's result doesn't depend on its neighbours
    for w in JOINED:
        for phase in range(w):
            begin = line[place % w == phase]
            begin = begin[begin + w <= stop[begin]]
            yield 1, begin, begin + w


def _likely(p: Paragraphs, hits, begin, end, weights, bias, temperature):
    """(unit, class, probability) of the units that the model takes for a notice."""
    none = np.zeros(0, np.int64)
    if not len(begin) or not len(weights):
        return none, none, np.zeros(0)
    at, size, row = hits
    unit = np.searchsorted(p.offsets[begin], at, "right") - 1
    inside = (unit >= 0) & (at + size <= p.offsets[end][unit])
    key = np.unique(unit[inside] * len(weights) + row[inside])  # each n-gram counts once
    unit, feature = key // len(weights), key % len(weights)
    own, which = np.unique(unit, return_inverse=True)
    raw = np.stack([np.bincount(which, weights=weights[feature, c], minlength=len(own)) for c in range(len(bias))], axis=1) + bias
    prob = _softmax(raw / temperature)
    best = prob.argmax(axis=1)
    most = prob[np.arange(len(own)), best]
    likely = (best > 0) & (most >= LEAST_PROBABILITY)
    return own[likely], best[likely], most[likely]


_OUT = "doc_id long, n_paragraphs long, n_licensed long, n_unconfirmed long, families array<string>, paragraphs array<int>, probability double"


def _scan(shared):
    def run(batches):
        number, weights, bias, temperature = shared.value
        known, names = templates(), ["", *FAMILIES]
        for whole in batches:
            for batch in slices(whole, "text"):
                p = paragraphs(batch.column("text"))
                found: dict[int, list[tuple[str, int, float]]] = {}
                covered: dict[int, list[tuple[str, int, int]]] = {}
                doubted: dict[int, set[int]] = {}
                first = np.searchsorted(p.doc, np.arange(batch.num_rows))
                hits = _hits(p, number)
                for least, begin, end in _units(p):
                    unit, best, prob = _likely(p, hits, begin, end, weights, bias, temperature)
                    for u, y, share in zip(unit.tolist(), best.tolist(), prob.tolist(), strict=True):
                        a, b = int(begin[u]), int(end[u])
                        doc = int(p.doc[a])
                        if least and any(c < b and d > a and (d - c > 1 or f == names[y]) for f, c, d in covered.get(doc, [])):
                            continue  # a line has it already, or more lines say more
                        pairs = _pairs(p.codes[p.offsets[a] : p.offsets[b]])
                        if any(len(t.pairs) >= least and t.must <= pairs and len(t.pairs & pairs) >= LEAST_SHARED * len(t.pairs) for t in known[y]):
                            found.setdefault(doc, []).append((names[y], a - int(first[doc]), share))
                            covered.setdefault(doc, []).append((names[y], a, b))
                            doubted.get(doc, set()).difference_update(range(a, b))
                        elif not least:
                            doubted.setdefault(doc, set()).add(a)
                for of in found.values():
                    of.sort(key=lambda x: x[1])
                rows = [(sorted({f for f, _, _ in found.get(d, [])}), [k for _, k, _ in found.get(d, [])], max((s for _, _, s in found.get(d, [])), default=0.0)) for d in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(p.lines, pa.int64()),
                        pa.array([len(k) for _, k, _ in rows], pa.int64()),
                        pa.array([len(doubted.get(d, ())) for d in range(batch.num_rows)], pa.int64()),
                        pa.array([f for f, _, _ in rows], pa.list_(pa.string())),
                        pa.array([k for _, k, _ in rows], pa.list_(pa.int32())),
                        pa.array([s for _, _, s in rows], pa.float64()),
                    ],
                    ["doc_id", "n_paragraphs", "n_licensed", "n_unconfirmed", "families", "paragraphs", "probability"],
                )

    return run


def scan(docs: DataFrame, negative_docs: int = NEGATIVE_DOCS) -> DataFrame:
    """doc_id, n_paragraphs, n_licensed, n_unconfirmed, families, paragraphs, probability for every row of docs (doc_id,
    text and any others).

    Every paragraph (a line with a word) of every whole text is scored, and so are neighbouring lines as one and whole blocks
    between blank lines, since notices are wrapped; a notice over several lines has the place of its first. The model has weights for few n-grams only, and a
    paragraph with none of them is unknown. n_licensed: paragraphs with a likely family that a notice of the family
    or a
    paragraph of its licence text confirms, by the share of its word pairs; families: theirs, sorted; paragraphs: their places among the text's
    paragraphs; probability: the highest; n_unconfirmed: likely ones that no notice confirms. The model is fitted on made
    notices, on licence texts, on sentences with the same words that name no family, and on all paragraphs of at most
    negative_docs documents of at most NEGATIVE_BYTES that don't speak of licences; it is fitted once for a sample in a process.
    A very long text is scanned whole, all its paragraphs by one task. Null or empty texts have no paragraphs. A null doc_id and repeated rows are rows like others. Equal scores go to the
    family first in the alphabet. An empty table gives no rows.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    able = table.filter(F.col("doc_id").isNotNull() & (F.coalesce(F.octet_length("text"), F.lit(0)) <= NEGATIVE_BYTES))
    chosen = able.select("doc_id").distinct().orderBy(F.md5(F.col("doc_id").cast("string"))).limit(negative_docs)
    sample = able.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").select("text").toArrow()
    model = fitted(negatives(sample.column("text").to_pylist()))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    return table.mapInArrow(frugal(_scan(shared)), _OUT)


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).select("doc_id", "n_paragraphs", "n_licensed", "n_unconfirmed", F.array_join("families", ",").alias("families"), "probability")
