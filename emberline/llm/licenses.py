"""Licence scans: a trained paragraph classifier, calibrated, confirmed by templates.

Paragraphs (lines) are cut in windows of words of two widths, and so are the running words of lines that no blank line
parts, as statements are often wrapped. Each window's sparse word 1- to 3-grams (which ones it has, not how often) go
through a multinomial logistic regression over licence families, ``unknown`` (reads like a licence, but of no family) and ``none``. Its
probabilities are calibrated by a temperature fitted by cross-validation: whole statements, with all that is made of them,
are left out of the fit that scores them. A family is reported only
if its calibrated probability is high enough and one of its templates is found in the window; a window that reads like
a licence but isn't confirmed is ``unknown``.

The model is fitted on the driver from the templates below, varied by rule, and a bounded sample of lines as ``none``.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, quoted

#: Statements by which each family is granted.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, without warranties or conditions of any kind.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the 3-clause BSD License.",
        "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GNU General Public License version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under a Creative Commons Attribution NonCommercial ShareAlike license.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying of this file is strictly prohibited.",
    ],
}
#: Reads like a licence, but of none of these families.
UNKNOWN_LIKE = [
    "Use of this material is subject to the terms of the licence agreement.", "Licensed under the terms found in the LICENSE file.",
    "Distributed under the Eclipse Public License.", "Licensed under the Open Software License version 3.", "You may use this work under its license.",
    "Released under a custom license; see the terms for conditions.", "This license grants you permission to use and distribute the material.",
]
#: Words of such statements in other use.
NONE_LIKE = [
    "The driver showed his license to the officer.", "A work of the public on the general terms of the day.", "The software is free of errors.", "He was released under guard.",
    "Permission to enter was granted by the person at the gate.", "Version 2 of the story is in the library.", "the of and to a in is you may use it", "under the law of the land", "This work is about the public and the foundation.",
]
UNKNOWN, NONE = "unknown", "none"
#: The bound of the sample of lines for ``none``: rows, lines, characters of a row.
ROWS, LINES, CHARS = 200, 2_000, 50_000
#: Words of the windows (each half covered by the next), what a family's probability and its template's share must be at
#: least.
WINDOWS, SURE, CONFIRMED = (16, 64), 0.5, 0.8
#: Folds of the cross-validation, temperatures to choose from.
FOLDS, TEMPERATURES = 4, np.geomspace(0.02, 20, 61)
#: Words scored together, unless one text has more; windows scored together.
TOGETHER, STEP = 200_000, 16_384
WORD, TOKEN = re.compile(r"[^\W_]+"), re.compile(r"[^\W_]+|\n")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def ngrams(ids: np.ndarray, n: int, base: int) -> np.ndarray:
    """Keys of the n-grams that begin at each place; -1 where a word outside the vocabulary (0) is in it."""
    size = len(ids) - n + 1
    if size <= 0:
        return np.full(len(ids), -1, np.int64)
    key, known = np.zeros(size, np.int64), np.ones(size, bool)
    for j in range(n):
        part = ids[j : j + size]
        key, known = key * base + part, known & (part > 0)
    return np.concatenate([np.where(known, key, -1), np.full(n - 1, -1, np.int64)])


def ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[i], lo[i] + 1, ... of n[i] numbers, for each i."""
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def cut(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the windows of both widths over the given stretches of words, each window once."""
    a, b = [], []
    for i, size in enumerate(WINDOWS):
        s, e = (x[ends - starts > (WINDOWS[i - 1] if i else 0)] for x in (starts, ends))  # else one window of the narrower width is all
        n = np.maximum(0, e - s - size // 2 - 1) // (size // 2) + 1
        a.append(np.repeat(s, n) + ranges(np.zeros_like(n), n) * (size // 2))
        b.append(np.minimum(a[-1] + size, np.repeat(e, n)))
    return np.concatenate(a), np.concatenate(b)


def tightest(pairs: np.ndarray, template: frozenset[int]) -> tuple[int, int]:
    """Begin and end of the shortest stretch of words with all of the template's word pairs that occur at all."""
    where = np.nonzero(np.isin(pairs, list(template)))[0].tolist()
    kinds, at, best = len({int(pairs[i]) for i in where}), {}, (0, len(pairs))
    for i in where:
        at[int(pairs[i])] = i
        if len(at) == kinds and (first := min(at.values())) + best[1] - best[0] > i + 2:
            best = (first, i + 2)
    return best


@dataclass
class Model:
    labels: list[str]
    vocab: dict[str, int]
    keys: list[np.ndarray]  # of 1-, 2- and 3-grams, sorted
    weights: list[np.ndarray]  # of each key, and a last row of zeros
    bias: np.ndarray
    temperature: tuple[float, float]  # of licence or not, and of the families of a licence
    reliability: tuple[float, float]  # mean gaps of the two between probability and share of right answers, on statements that the fit didn't see
    templates: dict[str, list[frozenset[int]]]

    def ids(self, own: Sequence[str]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, 0) for w in own), np.int64, len(own))

    def spots(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each n, the places of the n-grams that are features, and their rows in the joined weights."""
        out, first = [], 0
        for n, keys in enumerate(self.keys, 1):
            found = ngrams(ids, n, len(self.vocab) + 1)
            at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            where = np.nonzero(keys[at] == found)[0]
            out.append((where, first + at[where]))
            first += len(keys) + 1
        return out

    def probabilities(self, sums: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of each class; ``none`` is the last."""
        z = sums / np.sqrt(np.maximum(size, 8))[:, None] + self.bias
        either, family = (softmax(x / t) for x, t in zip(two_scores(z), self.temperature))
        return np.concatenate([either[:, :1] * family, either[:, 1:]], axis=1)

    def licence(self, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The calibrated probability of a licence of each window, and its class probabilities; 0 without a feature."""
        spots, joined = self.spots(ids), np.concatenate(self.weights)
        chance, p = np.zeros(len(a)), np.zeros((len(a), len(self.labels)))
        for at in range(0, len(a), STEP):
            s, e = a[at : at + STEP], b[at : at + STEP]
            found = []
            for n, (where, row) in enumerate(spots, 1):
                lo = np.searchsorted(where, s)
                many = np.maximum(0, np.searchsorted(where, e - n, side="right") - lo)
                found.append(np.repeat(np.arange(len(s)), many) * len(joined) + row[ranges(lo, many)])
            window, row = np.divmod(np.unique(np.concatenate(found)), len(joined))
            if not len(window):
                continue
            first = np.nonzero(np.diff(window, prepend=-1))[0]
            own, sums = window[first], np.add.reduceat(joined[row], first, axis=0)
            p[at + own] = self.probabilities(sums, (e - s)[own])
            chance[at + own] = 1 - p[at + own, self.labels.index(NONE)]
        return chance, p

    def similarity(self, family: str, ids: np.ndarray) -> float:
        """The greatest share of a template's word pairs that are in ids."""
        return self.nearest(family, ngrams(ids, 2, len(self.vocab) + 1))[0]

    def nearest(self, family: str, pairs: np.ndarray) -> tuple[float, frozenset[int]]:
        own = set(pairs.tolist())
        return max(((len(t & own) / len(t), t) for t in self.templates[family]), key=lambda x: x[0], default=(0.0, frozenset()))

    def confirmed(self, ids: np.ndarray, a: int, b: int, chance: float, p: np.ndarray) -> Iterator[tuple[bool, str, float, float, int, int]]:
        """(sure in the window, family, probability, similarity, begin and end of what the template matches) of a window that
        reads like a licence, for each family. One that shares it with others must be sure in the words its template matches."""
        pairs = ngrams(ids[a:b], 2, len(self.vocab) + 1)
        for at in np.argsort(-p).tolist():
            if (family := self.labels[at]) in (NONE, UNKNOWN):
                continue
            near, template = self.nearest(family, pairs)
            if near < CONFIRMED:
                continue
            first, end = (a + x for x in tightest(pairs, template))
            own, q = chance, p
            if not (sure := q[at] / own >= SURE):
                (own,), (q,) = self.licence(ids[first:end], np.array([0]), np.array([end - first]))
            if own >= 0.5 and q[at] / own >= SURE:
                yield bool(sure), family, float(own), near, first, end

    def scan(self, texts: Sequence[str]) -> list[tuple[int, float, list[dict]]]:
        """(paragraphs, greatest probability of a licence, hits) of each text."""
        get, parts = {**self.vocab, "\n": -1}.get, []
        for text in texts:
            own = TOKEN.findall(text.lower())
            parts += [np.fromiter((get(w, 0) for w in own), np.int64, len(own)), np.array([-1, -1])]
        codes = np.concatenate([*parts, np.zeros(0, np.int64)])
        word = codes >= 0
        ids, number = codes[word], np.cumsum(~word)[word]
        text_of = np.repeat(np.arange(len(texts)), [len(x) + 2 for x in parts[::2]])[word]
        starts = np.nonzero(np.diff(number, prepend=-1))[0]  # of the lines with a word
        ends = np.append(starts[1:], len(ids))[: len(starts)]
        line_of, owner = np.repeat(np.arange(len(starts)), ends - starts), text_of[starts]
        heads = np.nonzero(np.diff(number[starts], prepend=-2) > 1)[0]  # lines that begin a block: one line or more, no blank one among them
        last = np.append(heads[1:], len(starts))[: len(heads)] - 1
        wrapped = last > heads
        counts = np.bincount(owner, minlength=len(texts))
        before = np.cumsum(counts) - counts
        out: list[tuple[int, float, list[dict]]] = [(int(n), 0.0, []) for n in counts]
        a, b = cut(starts, ends)
        across = cut(starts[heads[wrapped]], ends[last[wrapped]])
        more = line_of[across[0]] != line_of[across[1] - 1]
        a, b, crosses = np.concatenate([a, across[0][more]]), np.concatenate([b, across[1][more]]), np.repeat([False, True], [len(a), more.sum()])
        chance, p = self.licence(ids, a, b)
        top = np.zeros(len(texts))
        np.maximum.at(top, text_of[a], chance)
        some = np.nonzero(chance >= 0.5)[0]
        some = some[np.lexsort((-chance[some], crosses[some], text_of[a[some]]))]  # of each text its lines first, then what crosses them
        for group in np.split(some, np.nonzero(np.diff(text_of[a[some]]))[0] + 1):
            if len(group):
                at = int(text_of[a[group[0]]])
                hits = self.hits(ids, line_of, [(int(a[i]), int(b[i]), float(chance[i]), p[i]) for i in group])
                out[at] = (out[at][0], float(top[at]), [{"paragraph": line - int(before[at]), "family": f, "probability": round(q, 6), "similarity": round(near, 6)} for line, f, q, near in hits])
        return [(n, float(t), hits) for (n, _, hits), t in zip(out, top)]

    def hits(self, ids: np.ndarray, line_of: np.ndarray, windows: list[tuple[int, int, float, np.ndarray]]) -> list[tuple[int, str, float, float]]:
        """(line, class, probability, similarity) from a text's windows that read like a licence, best first, those in one
        line before those across lines. A statement is told of the line it begins in, each family once a line, and the lines it takes aren't unknown."""
        told: list[tuple[int, str, float, float]] = []
        spans: list[tuple[int, int]] = []  # in order, none in another
        taken, seen = set(), set()
        found = [(not sure, bool(line_of[a] != line_of[b - 1]), -near, -q, family, first, end) for a, b, chance, p in windows for sure, family, q, near, first, end in self.confirmed(ids, a, b, chance, p)]
        for _, _, near, q, family, first, end in sorted(found):
            line = int(line_of[first])
            at = bisect(spans, (first, end))
            if any(first < y and x < end for x, y in spans[max(0, at - 1) : at + 1]):
                continue  # the same words are one statement, of the family that matches best
            spans.insert(at, (first, end))
            taken.update(range(line, int(line_of[end - 1]) + 1))
            if (line, family) not in seen:
                seen.add((line, family))
                told.append((line, family, -q, -near))
        for a, b, chance, p in windows:
            lines = range(int(line_of[a]), int(line_of[b - 1]) + 1)
            if taken.isdisjoint(lines):
                family = max((j for j, label in enumerate(self.labels) if label not in (NONE, UNKNOWN)), key=lambda j: p[j])
                known = np.nonzero(ngrams(ids[a:b], 2, len(self.vocab) + 1) >= 0)[0]
                line = int(line_of[a + int(known[0])]) if len(known) else lines[0]
                told.append((line, UNKNOWN, chance, self.similarity(self.labels[family], ids[a:b])))
                taken.update(lines)
        return sorted(told, key=lambda x: x[0])


def varied(text: str, rng: np.random.Generator) -> Iterator[str]:
    """The statement as it is, in other case, without some words, with words around it."""
    own = text.split()
    yield text
    yield text.upper()
    yield "Copyright (c) 2020 the authors. " + text
    for _ in range(3):
        keep = [w for w in own if rng.random() > 0.12] or own
        yield " ".join(keep)
        fill = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(int(rng.integers(1, 24)))]
        cut = int(rng.integers(len(fill) + 1))
        yield " ".join(fill[:cut] + own + fill[cut:])


def weights_of(x: np.ndarray, y: np.ndarray, k: int, steps: int, rate: float, weak: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of k classes, each with the same share in the loss, by full-batch steps of AdaGrad."""
    share = (1 / np.maximum(1, np.bincount(y, minlength=k))[y] / k)[:, None].astype(np.float32)
    hot = np.eye(k, dtype=np.float32)[y]
    w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k, np.float32)
    qw, qb = np.full(w.shape, 1e-8, np.float32), np.full(b.shape, 1e-8, np.float32)
    for _ in range(steps):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = (p / p.sum(axis=1, keepdims=True) - hot) * share
        dw, db = x.T @ d + weak * w / k, d.sum(axis=0)
        qw, qb = qw + dw * dw, qb + db * db
        w, b = w - rate * dw / np.sqrt(qw) * 0.2, b - rate * db / np.sqrt(qb) * 0.2
    return w.astype(np.float64), b.astype(np.float64)


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def two_scores(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the classes' scores (``none`` last) those of licence or not, and those of the families of a licence."""
    own, most = z[:, :-1], z[:, :-1].max(axis=1, keepdims=True)
    return np.concatenate([most + np.log(np.exp(own - most).sum(axis=1, keepdims=True)), z[:, -1:]], axis=1), own


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature with the least loss over held-out scores, each class with the same share, and what gap between
    probability and share of right answers (over ten bins of probability) it leaves."""
    share = 1 / np.maximum(1, np.bincount(y))[y]
    temperature = float(min(TEMPERATURES, key=lambda t: float(-(share * np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12))).sum())))
    p = softmax(z / temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    bins = np.minimum((top * 10).astype(int), 9)
    gaps = np.abs(np.bincount(bins, share * top, 10) - np.bincount(bins, share * right, 10))
    return temperature, float(gaps.sum() / share.sum())


def fit(lines: Sequence[str], seed: int = 1, steps: int = 200, rate: float = 1.0, weak: float = 1e-4, folds: int = FOLDS) -> Model:
    """The model from the templates and a sample of lines that are no licence."""
    rng = np.random.default_rng(seed)
    labels = [*TEMPLATES, UNKNOWN, NONE]
    vocab = {w: i for i, w in enumerate(sorted({w for group in (*TEMPLATES.values(), UNKNOWN_LIKE) for t in group for w in words(t)}), 1)}
    base, blank = len(vocab) + 1, Model(labels, vocab, [], [], np.zeros(len(labels)), (1.0, 1.0), (0.0, 0.0), {})
    statements = [*((t, labels.index(f)) for f, group in (*TEMPLATES.items(), (UNKNOWN, UNKNOWN_LIKE)) for t in group), *((t, len(labels) - 1) for t in NONE_LIKE)]
    texts, fold, last = [], [], Counter()
    for t, c in statements:  # the folds take the statements of a class in turn, each with all that is made of it
        made = [(v, c) for v in varied(t, rng)]
        texts += made
        fold += [last[c] % folds] * len(made)
        last[c] += 1
    stated = len(texts)
    order = list(vocab)  # the same words in no order, and one word again and again, are no licence
    texts += [(" ".join(order[j] for j in rng.integers(len(order), size=int(rng.integers(2, 40)))), len(labels) - 1) for _ in range(300)] + [(f"{w} " * 12, len(labels) - 1) for w in order]
    parts = [words(x)[i : i + size] for x in lines for size in WINDOWS for i in range(0, max(1, len(words(x)) - size // 2), size // 2)][:LINES]
    texts += [(" ".join(x), len(labels) - 1) for x in parts] + [("", len(labels) - 1)] * 20
    fold = np.array(fold + [i % folds for i in range(len(texts) - len(fold))])
    ids = [blank.ids(words(t)[: max(WINDOWS)]) for t, _ in texts]
    keys = [np.unique(np.concatenate([(k := ngrams(x, n, base))[k >= 0] for x in ids[:stated]])) for n in (1, 2, 3)]  # features are what statements have
    keys = [k if len(k) else np.array([0]) for k in keys]
    first = np.cumsum([0, *map(len, keys)])
    x = np.zeros((len(texts), first[-1]), np.float32)
    for i, own in enumerate(ids):
        for n, k in enumerate(keys, 1):
            found = ngrams(own, n, base)
            x[i, first[n - 1] + np.searchsorted(k, found[np.isin(found, k)])] = 1
        x[i] /= np.sqrt(max(8, len(own)))
    y = np.array([c for _, c in texts])
    held = np.zeros((len(y), len(labels)))
    for f in range(folds if steps > 1 else 0):
        own, b = weights_of(x[fold != f], y[fold != f], len(labels), steps, rate, weak)
        held[fold == f] = x[fold == f] @ own + b
    found = ((1.0, 0.0), (1.0, 0.0))
    if steps > 1:
        either, family = two_scores(held)
        some = y < len(labels) - 1
        found = calibrated(either, (~some).astype(int)), calibrated(family[some], y[some])
    temperature, reliability = zip(*found)
    w, b = weights_of(x, y, len(labels), steps, rate, weak)
    weights = [np.concatenate([w[first[n] : first[n + 1]], np.zeros((1, len(labels)))]) for n in range(3)]
    templates = {f: [frozenset(ngrams(blank.ids(words(t)), 2, base).tolist()) - {-1} for t in group] for f, group in TEMPLATES.items()}
    return Model(labels, vocab, keys, weights, b, temperature, reliability, templates)


def blocks(text: str) -> Iterator[list[str]]:
    """The text's lines, those together that no line without a word parts; such lines alone."""
    held: list[str] = []
    for line in text.split("\n"):
        if WORD.search(line):
            held.append(line)
            continue
        if held:
            yield held
        yield [line]
        held = []
    if held:
        yield held


def learn(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rows: int = ROWS, lines: int = LINES, chars: int = CHARS) -> Model:
    """Fits the model; lines that share half of a template's word pairs, alone or with the lines they run on with, are not
    taken as ``none``. The sample is the rows whose ids have the least hashes, of ``chars`` characters at most, whatever the
    order of files; ids alone are read to find them. Without ids there are no such lines."""
    plain = fit([], steps=1)
    ids = docs.select(quoted(id_col).alias("id")).where(F.col("id").isNotNull())
    chosen = [r.id for r in ids.orderBy(F.xxhash64("id"), "id").limit(rows).collect()]
    told = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).where(F.col("id").isin(chosen) & (F.length("text") <= chars))
    some = [r.text for r in told.orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(rows).collect()]
    found = []
    for block in (x for t in some for x in blocks(t)):
        if len(found) >= lines:
            break
        own = [plain.ids(words(line)) for line in block]
        line_of = np.repeat(np.arange(len(own)), [len(x) for x in own])
        ids = np.concatenate(own)
        stated = {k for k, x in enumerate(own) if any(plain.similarity(f, x) >= 0.5 for f in TEMPLATES)}
        for a, b in zip(*cut(np.array([0]), np.array([len(ids)]))) if len(own) > 1 else ():
            if line_of[a] != line_of[b - 1] and any(plain.similarity(f, ids[a:b]) >= 0.5 for f in TEMPLATES):
                stated.update(line_of[a:b].tolist())
        found += [line for k, line in enumerate(block) if k not in stated]
    found = found[:lines]
    return fit(found)


def scanned(model: Model, texts: Sequence[str | None]) -> Iterator[tuple[int, float, list[dict]]]:
    """Model.scan of all texts, of some at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size > 6 * TOGETHER:
            yield from model.scan(held)
            held, size = [], 0
    yield from model.scan(held)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_paragraphs, n_licences, licences, n_unknown, score, hits for each row.

    licences: the confirmed families, each once, in order of their first paragraph; n_unknown: paragraphs that read
    like a licence of no confirmed family; score: the greatest calibrated probability of a licence; hits: paragraph,
    family, probability and template similarity of each family of a paragraph, or of a paragraph that is ``unknown``. A paragraph is a line with a
    word; a statement that is wrapped over lines is a hit of the one it begins in, and ends at a line without words. Null and empty texts have none; repeated rows are scanned each; an empty table gives an empty result; other
    columns of docs are ignored, whatever their names. Paragraphs are of any length. Of families that match the same words
    equally well, the more probable one is told, then the one that comes first by name.
    """
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    hit = pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for count, top, hits in scanned(m, b.column(1).to_pylist()):
                families = list(dict.fromkeys(h["family"] for h in hits if h["family"] != UNKNOWN))
                unknown = sum(h["family"] == UNKNOWN for h in hits)
                for column, v in zip(out, (count, len(hits) - unknown, ",".join(families), unknown, round(top, 6), hits)):
                    column.append(v)
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.list_(hit)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(v, t) for v, t in zip(out, types)]], names=["doc_id", "n_paragraphs", "n_licences", "licences", "n_unknown", "score", "hits"])

    return arrow_map(rows, run, f"doc_id {id_type}, n_paragraphs long, n_licences long, licences string, n_unknown long, score double, hits array<struct<paragraph:long,family:string,probability:double,similarity:double>>")
