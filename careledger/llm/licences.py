"""Licence families of documents by a trained paragraph classifier.

Paragraphs (lines) become sparse counts of word 1- to 3-grams. Logistic regression, one class against the
rest for each family, is fitted on the families' templates and shortened or altered copies of them, with
paragraphs of the corpus as the unknown class (a bounded sample, SAMPLE_PARAGRAPHS). A family's threshold is
set on held-out rows so that unknown paragraphs stay unknown. A prediction counts only if the paragraph also
shares enough words, in order, with a template of the family: found as the share of the template's word
pairs, or of the paragraph's, that the other has.

Defined results: null and empty texts have no paragraphs; a paragraph may hold several families and each is
a row; a document without licence is returned with family null; repeated paragraphs count once each place;
documents of any number of paragraphs are read line by line, long lines by all stretches that hold enough
of a template, and so are notices that are wrapped over several lines.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import text_of

SAMPLE_PARAGRAPHS = 5_000
FEATURES = 4_096
COPIES = 60
STEPS, RATE, PENALTY = 300, 0.05, 1e-4
# Share of unknown held-out rows that may pass a family's threshold; least overlap with a template.
FALSE_POSITIVES, OVERLAP = 0.001, 0.6

# Usual notices of each family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the terms of the MIT license.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under the GNU Lesser General Public License, version 2.1 or later.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "creative_commons": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Available under CC BY-SA 4.0.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright (c) by the authors. All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
FAMILIES = tuple(TEMPLATES)
_WORDS = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")


def words(paragraph: str) -> list[str]:
    return _WORDS.findall(paragraph.lower())


def grams(found: list[str]) -> Counter:
    out = Counter(found)
    for n in (2, 3):
        out.update(" ".join(found[i : i + n]) for i in range(len(found) - n + 1))
    return out


def pairs(found: list[str]) -> set[tuple[str, str]]:
    return set(zip(found, found[1:]))


def overlap(family: str, found: list[str]) -> float:
    """The largest share of word pairs that a template and the paragraph have in common, of the shorter one."""
    own, best = pairs(found), 0.0
    for k, theirs in _PAIRS:
        small = min(len(own), len(theirs))
        # A single pair tells only if it is the whole of a template.
        if FAMILIES[k] == family and small and (len(own) >= 2 or theirs <= own):
            best = max(best, len(own & theirs) / small)
    return best


def share_held(family: str, found: list[str]) -> float:
    """The largest share of a template's word pairs that the paragraph holds."""
    own = pairs(found)
    return max(len(own & theirs) / len(theirs) for k, theirs in _PAIRS if FAMILIES[k] == family)


#: The word pairs of each template with its family, and the templates that hold a pair.
_PAIRS = [(k, pairs(words(t))) for k, ts in enumerate(TEMPLATES.values()) for t in ts]
_HOLDS: dict[tuple[str, str], list[int]] = {}
for _i, (_, _theirs) in enumerate(_PAIRS):
    for _pair in _theirs:
        _HOLDS.setdefault(_pair, []).append(_i)
# Words of a paragraph up to which it is read whole; words by which a notice inside of a text may exceed its
# template; least words of a notice that is cut off at the end of its paragraph.
WHOLE, LONGER, LEAST_CUT = 32, 12, 6


@dataclass
class Model:
    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((len(FAMILIES), 0)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(len(FAMILIES)))
    thresholds: np.ndarray = field(default_factory=lambda: np.ones(len(FAMILIES)))

    def chances(self, found: list[str]) -> np.ndarray:
        at, n = [], []
        for g, k in grams(found).items():
            if (i := self.vocabulary.get(g)) is not None:
                at.append(i)
                n.append(1 + np.log(k))
        x = np.array(n)
        x = x / (np.sqrt((x * x).sum()) or 1)
        return 1 / (1 + np.exp(-(self.weights[:, at] @ x + self.bias)))

    def notices(self, window: list[str]) -> list[tuple[str, float, float]]:
        """(family, probability, overlap) of the families of a window."""
        shares = {k: share for k, family in enumerate(FAMILIES) if (share := overlap(family, window)) >= OVERLAP}
        if not shares:
            return []
        chances = self.chances(window)
        return [(FAMILIES[k], float(chances[k]), s) for k, s in shares.items() if chances[k] >= self.thresholds[k]]

    def scan(self, text: str) -> list[tuple[int, str, float, float]]:
        """(paragraph, family, probability, overlap) of each notice; one over several lines counts for its
        first line, unless one of its lines is a notice of the family by itself."""
        lines = [words(line) for line in text.split("\n")]
        stream = list(chain.from_iterable(lines))
        # A stretch without a template's pair has no overlap, so nothing is lost by reading on from these only.
        hits = [i for i, pair in enumerate(zip(stream, stream[1:])) if pair in _HOLDS]
        if not hits:
            return []
        starts = list(accumulate((len(line) for line in lines), initial=0))
        best: dict[tuple[int, str], tuple[float, float]] = {}

        def keep(line: int, found: list[tuple[str, float, float]]) -> None:
            for family, chance, share in found:
                best[line, family] = max(best.get((line, family), (0.0, 0.0)), (chance, share))

        for line in sorted({bisect_right(starts, i) - 1 for i in hits}):
            if len(lines[line]) <= WHOLE:
                keep(line, self.notices(lines[line]))
        across = []
        for first, end in sorted(windows(stream, hits)):
            line, last = bisect_right(starts, first) - 1, bisect_right(starts, end - 1) - 1
            if line < last:
                across.append((line, last, first, end))
            elif len(lines[line]) > WHOLE:
                keep(line, self.notices(stream[first:end]))
        for first in hits:
            line = bisect_right(starts, first) - 1
            if len(lines[line]) > WHOLE and LEAST_CUT <= starts[line + 1] - first <= WHOLE:
                keep(line, self.notices(stream[first : starts[line + 1]]))
        alone = {}
        for line, family in sorted(best):
            alone.setdefault(family, []).append(line)
        for line, last, first, end in across:
            read = self.notices(stream[first:end])
            found = [n for n in read if not _between(alone.get(n[0], []), line, last)]
            # A line that is a fragment of this notice is none of another family that begins alike.
            for i in range(line, last + 1) if read else ():
                if first <= starts[i] and starts[i + 1] <= end:
                    for family in FAMILIES:
                        if (i, family) in best and family not in {n[0] for n in read} and share_held(family, lines[i]) < OVERLAP:
                            del best[i, family]
            keep(line, found)
            # The further windows of the same notice add nothing.
            for family, *_ in found:
                insort(alone.setdefault(family, []), last)
        return [(i, family, *both) for (i, family), both in sorted(best.items())]


def _between(lines: list[int], low: int, high: int) -> bool:
    at = bisect_left(lines, low)
    return at < len(lines) and lines[at] <= high


def windows(stream: list[str], hits: list[int]) -> set[tuple[int, int]]:
    """(first, end) of all stretches, up to LONGER words longer than a template and WHOLE at least, that hold
    the share OVERLAP of the template's pairs, from their first such pair to their last; hits: where any
    template's pair stands."""
    at: dict[int, list[int]] = {}
    for i in hits:
        for t in _HOLDS[stream[i], stream[i + 1]]:
            at.setdefault(t, []).append(i)
    out = set()
    for t, places in at.items():
        need, size = OVERLAP * len(_PAIRS[t][1]), max(WHOLE, len(_PAIRS[t][1]) + 1 + LONGER)
        if len(places) < need:
            continue
        inside, left = Counter(), 0
        for i in places:
            inside[stream[i], stream[i + 1]] += 1
            while places[left] < i + 2 - size:
                pair = stream[places[left]], stream[places[left] + 1]
                inside[pair] -= 1
                if not inside[pair]:
                    del inside[pair]
                left += 1
            if len(inside) >= need:
                out.add((places[left], i + 2))
    return out


def sample(docs: DataFrame, text_col: str, size: int) -> list[str]:
    """About size paragraphs of the corpus, chosen by hash."""
    lines = docs.select(F.explode(F.split(text_of(text_col), "\n")).alias("line")).where("length(line) > 0")
    total = lines.count()
    part = lines.where(
        F.pmod(F.xxhash64("line"), F.lit(1_000_000)) < F.lit(min(1_000_000, int(1_000_000 * size / max(total, 1)) + 1))
    ).select(F.substring("line", 1, 400).alias("line")).distinct().orderBy(F.xxhash64("line")).limit(2 * size)
    return [r["line"] for r in part.collect()]


def _altered(found: list[str], other: list[str], draw: np.random.Generator) -> list[str]:
    """A copy with words dropped or swapped, between some words of other."""
    kept = [w for w in found if draw.random() > 0.1] or found
    if draw.random() < 0.3 and len(kept) > 8:
        kept = kept[: int(draw.integers(6, len(kept)))]
    a, b = (int(draw.integers(0, 6)) if draw.random() < 0.5 else 0 for _ in range(2))
    return other[:a] + kept + other[a : a + b]


def fit(docs: DataFrame, text_col: str = "text", sample_paragraphs: int = SAMPLE_PARAGRAPHS) -> Model:
    draw = np.random.default_rng(7)
    templates = {" ".join(words(t)) for ts in TEMPLATES.values() for t in ts}
    plain = [words(p) for p in sample(docs, text_col, sample_paragraphs)]
    # Paragraphs that repeat a template are no examples of the unknown class.
    plain = [p for p in plain if p and not any(t in " ".join(p) for t in templates)] or [["none"]]
    rows, labels = [], []
    for k, family in enumerate(FAMILIES):
        for t in TEMPLATES[family]:
            for i in range(COPIES):
                other = plain[int(draw.integers(len(plain)))]
                rows.append(words(t) if i == 0 else _altered(words(t), other, draw))
                labels.append(k)
    rows += [p[:64] for p in plain]
    labels += [-1] * len(plain)
    held = draw.random(len(rows)) < 0.25
    y = np.array(labels)
    df = Counter(g for r, h, label in zip(rows, held, labels) if not h and label >= 0 for g in grams(r).keys())
    known = Counter(g for t in templates for g in grams(t.split()))
    vocabulary = {g: i for i, (g, _) in enumerate(sorted(((g, n) for g, n in df.items() if g in known), key=lambda x: (-x[1], x[0]))[:FEATURES])}
    model = Model(vocabulary, np.zeros((len(FAMILIES), len(vocabulary))))
    x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    for i, r in enumerate(rows):
        for g, k in grams(r).items():
            if g in vocabulary:
                x[i, vocabulary[g]] = 1 + np.log(k)
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    t = (y[:, None] == np.arange(len(FAMILIES))[None, :]).astype(np.float32)
    w, b = np.zeros((len(FAMILIES), len(vocabulary)), np.float32), np.full(len(FAMILIES), -3.0, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    train = x[~held]
    for step in range(1, STEPS + 1):
        e = 1 / (1 + np.exp(-(train @ w.T + b))) - t[~held]
        g = e.T @ train / len(train) + PENALTY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b -= RATE * e.mean(0) * 20
    model.weights, model.bias = w.astype(float), b.astype(float)
    chance = 1 / (1 + np.exp(-(x[held] @ w.T + b)))
    for k in range(len(FAMILIES)):
        other = np.sort(chance[y[held] != k, k])
        model.thresholds[k] = max(0.5, float(other[int(len(other) * (1 - FALSE_POSITIVES)) - 1]) + 1e-6) if len(other) else 0.5
        model.thresholds[k] = min(model.thresholds[k], 0.95)
    return model


def licences(model: Model, text: str = "text") -> Column:
    """Array of (paragraph, family, probability, overlap) of a text column."""

    @F.pandas_udf("array<struct<paragraph:int,family:string,probability:double,overlap:double>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("paragraph", "family", "probability", "overlap")
        for part in texts:
            yield part.map(lambda t: [dict(zip(names, hit)) for hit in model.scan(t)])

    return run(text_of(text))
