"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines) become sets of word bigrams and trigrams that occur in
licence notices. Softmax regression over these sparse features names a licence
family or ``unknown``; it is trained on damaged notices, on word runs too
short to tell, and on paragraphs of a bounded corpus sample. The chance from
which a family is believed is calibrated on notices and paragraphs left out of
training, and a prediction stands only if it shares enough n-grams with a
notice of its family.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.llm.labelled import hashed_share

#: Documents whose paragraphs stand for the unknown class, at most (chosen by hash).
SAMPLE_DOCS = 2_000
#: Share of a notice's n-grams, or of the paragraph's own, that confirms a prediction.
CONFIRM = 0.6
#: Damaged copies of each notice it is trained on.
COPIES = 40
UNKNOWN = "unknown"

# The short notices by which works are put under common licences.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released into the public domain.",
    ),
    "Reserved": (
        "All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}
FAMILIES = [UNKNOWN, *NOTICES]

_WORD = re.compile("[a-z0-9]+")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def _ngrams(words: list[str]) -> set[tuple[str, ...]]:
    return {*zip(words, words[1:]), *zip(words, words[1:], words[2:])}


_TEMPLATES = [(FAMILIES.index(f), _ngrams(words_of(t))) for f, texts in NOTICES.items() for t in texts]
_VOCABULARY = {g: i for i, g in enumerate(sorted(set().union(*(g for _, g in _TEMPLATES))))}
_BIGRAMS = frozenset(g for g in _VOCABULARY if len(g) == 2)


def features(words: list[str]) -> list[int]:
    """Numbers of the known n-grams of a paragraph, each once, ascending."""
    pairs = _BIGRAMS.intersection(zip(words, words[1:]))
    if not pairs:
        return []
    triples = _VOCABULARY.keys() & set(zip(words, words[1:], words[2:]))
    return sorted(_VOCABULARY[g] for g in {*pairs, *triples})


def likeness(words: list[str], family: int) -> float:
    """Largest share of a notice's n-grams in the paragraph, or of the paragraph's in a notice (of four words at least)."""
    own, best = _ngrams(words), 0.0
    for f, grams in _TEMPLATES:
        if f == family:
            both = len(own & grams)
            best = max(best, both / len(grams), both / len(own) if len(words) >= 4 else 0.0)
    return best


@dataclass
class Model:
    weights: np.ndarray   # (n-grams, families)
    base: np.ndarray
    believe: float        # chance from which a family is believed

    def chances(self, found: list[int]) -> np.ndarray:
        z = self.base + self.weights[found].sum(0)
        e = np.exp(z - z.max())
        return e / e.sum()

    def classify(self, words: list[str]) -> tuple[str, float, float] | None:
        """(family, chance, likeness), None for unknown. Without any known n-gram a paragraph is unknown."""
        found = features(words)
        if not found:
            return None
        p = self.chances(found)
        k = int(p.argmax())
        if k == 0 or p[k] < self.believe:
            return None
        like = likeness(words, k)
        return (FAMILIES[k], float(p[k]), like) if like >= CONFIRM else None


def _damaged(words: list[str], rng) -> list[str]:
    """A run of at least two thirds of the words, one in twelve of them lost."""
    n = len(words)
    m = int(rng.integers(max(min(n, 3), -(-2 * n // 3)), n + 1))
    first = int(rng.integers(0, n - m + 1))
    return [w for w in words[first:first + m] if m < 6 or rng.random() > 1 / 12]


def train(unknown: list[list[int]], rounds: int = 200, rate: float = 0.3, l2: float = 1e-4) -> Model:
    """``unknown``: features of corpus paragraphs."""
    rng = np.random.default_rng(5)
    rows: list[tuple[list[int], int]] = []
    for family, texts in NOTICES.items():
        for text in texts:
            words = words_of(text)
            rows += [(features(words), FAMILIES.index(family))] * 4
            for _ in range(COPIES):
                rows.append((features(_damaged(words, rng)), FAMILIES.index(family)))
                first = int(rng.integers(0, max(1, len(words) - 2)))
                rows.append((features(words[first:first + 2]), 0))  # two words tell nothing
    rows += [(u, 0) for u in unknown]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    x = np.zeros((len(rows), len(_VOCABULARY)), np.float32)
    for i, (found, _) in enumerate(rows):
        x[i, found] = 1
    y = np.array([f for _, f in rows])
    fit = np.arange(len(rows)) % 5 > 0
    target = np.eye(len(FAMILIES), dtype=np.float32)[y]
    share = np.bincount(y[fit], minlength=len(FAMILIES)).astype(np.float32)
    weight = (1 / np.sqrt(np.maximum(share, 1)))[y[fit], None]
    weight /= weight.sum()
    w, b = np.zeros((x.shape[1], len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
    m1, m2, n1, n2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, rounds + 1):
        z = x[fit] @ w + b
        e = np.exp(z - z.max(1, keepdims=True))
        d = (e / e.sum(1, keepdims=True) - target[fit]) * weight
        for p, g, m, v in ((w, x[fit].T @ d + l2 * w, m1, m2), (b, d.sum(0), n1, n2)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    model = Model(w, b, 0.0)
    held = np.flatnonzero(~fit)
    chance = np.array([model.chances(rows[i][0]) for i in held])
    best, top = chance.argmax(1), chance.max(1)
    grid = np.linspace(0.2, 0.99, 80)
    errors = [(np.where((best > 0) & (top >= c), best, 0) != y[held]).mean() for c in grid]
    good = grid[np.array(errors) <= min(errors) + 1e-12]
    model.believe = float((good[0] + good[-1]) / 2)
    return model


def _unknown_features(batches):
    for batch in batches:
        out = []
        for t in batch.column(0):
            for line in (t.as_py() or "").split("\n"):
                words = words_of(line)
                if words and all(likeness(words, f) < CONFIRM / 2 for f in range(1, len(FAMILIES))):
                    out.append(features(words))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], names=["x"])


def fit(docs: DataFrame) -> Model:
    """Unknown paragraphs: those of SAMPLE_DOCS documents that resemble no notice, each set of features once."""
    texts = docs.filter("text is not null")
    got = (texts.filter(hashed_share(F.struct("doc_id", "text"), SAMPLE_DOCS, texts.count())).select("text")
           .mapInArrow(_unknown_features, "x array<long>").distinct().collect())
    return train(sorted(r["x"] for r in got))


def _scan(model: Model):
    fields = pa.list_(pa.struct([("paragraph", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                                 ("family", pa.string()), ("chance", pa.float64()), ("likeness", pa.float64())]))

    def run(batches):
        for batch in batches:
            found, counts = [], []
            for t in batch.column(1):
                own, at = [], 0
                lines = (t.as_py() or "").split("\n")
                for i, line in enumerate(lines):
                    if got := model.classify(words_of(line)):
                        own.append(dict(zip(("paragraph", "start", "end", "family", "chance", "likeness"),
                                            (i, at, at + len(line), *got))))
                    at += len(line) + 1
                found.append(own)
                counts.append(sum(1 for x in lines if x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, fields)],
                                             names=["doc_id", "n_paragraphs", "found"])
    return run


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, found: array of (paragraph, start, end, family, chance, likeness)) for every
    row of ``docs``: its paragraphs that aren't empty, and those that put it under a licence, by code points.
    Null and empty texts have none; rows that repeat are scanned each."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(fit(docs)), "doc_id long, n_paragraphs long, found array<struct<paragraph:bigint,start:bigint,"
                          "end:bigint,family:string,chance:double,likeness:double>>")
