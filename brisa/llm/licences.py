"""Licence notices by a trained paragraph classifier, confirmed against templates.

A block is a run of lines with letters or digits, so notices wrapped over lines, and behind comment
marks, are read as one.  A passage is a stretch of a block where word pairs of the training notices
follow each other closely, looked for with narrow and with wide gaps; stretches beyond `WINDOW`
words are read in overlapping windows.  A passage is described by the word n-grams, one and two words
long, that the notices use.  Multinomial logistic regression weighs each family against "unknown".
A family is reported if its probability passes the calibrated threshold and the passage covers
enough of one of the family's notices, word pair by word pair; likelier families go first, and one
whose matching words all lie within those of another is explained by it.  So a passage may name
several licences, and GPL-3.0 is not taken for AGPL-3.0 too.

Training notices are the templates below, varied: words dropped, put into other words, cut.  The
unknown class is learnt from mixed-up templates, from near misses (pieces of notices too short to
count, notices in disorder) and from passages of the corpus (of at most `sample` lines, those with
the smallest hashes) that cover no template.  The threshold is the lowest one that lets at most
`allowed` of the near misses and of the unknown passages pass that were kept out of training.

Texts and lines of any length are read whole.  Null and empty texts have no paragraphs; n_paragraphs
counts lines that are not blank.  A carriage return is a space: a text broken by it alone is one
line.  Rows that repeat give a row each; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brisa.llm.common import below, slices, texts

SAMPLE, ALLOWED, COVER = 5_000, 0.01, 0.6
GAPS, WINDOW = (2, 8), 96
UNKNOWN = "unknown"
#: Usual notices of licence families, with the identifiers of the public licence list.
NOTICES = {
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "under the Apache License",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0, dedicated to the public domain.",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License.",
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "LGPL-3.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 3.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
    ),
}
FAMILIES = (*NOTICES, UNKNOWN)
_WORD = re.compile(r"[a-z]+|[0-9]+")


def words(paragraph: str) -> list[str]:
    """Lower-case runs of letters a-z and of digits."""
    return _WORD.findall(paragraph.lower())


def pairs(own: list[str]) -> set[tuple[str, str]]:
    return set(zip(["", *own], [*own, ""], strict=True))


TEMPLATES = [(f, pairs(words(n))) for f, notices in NOTICES.items() for n in notices]
# n-grams that training notices use; a paragraph that has none of the single words needs no scores
GRAMS = sorted(
    {g for notices in NOTICES.values() for n in notices for w in [words(n)] for g in (*w, *zip(w, w[1:], strict=False))},
    key=str,
)
_NUMBER = {g: k for k, g in enumerate(GRAMS)}


def grams(own: list[str]) -> list[int]:
    found = [_NUMBER[g] for g in own if g in _NUMBER]
    return found + [_NUMBER[g] for g in zip(own, own[1:], strict=False) if g in _NUMBER]


PAIRS = frozenset(p for _, notice in TEMPLATES for p in notice if all(p))
BODIES = [(f, frozenset(p for p in notice if all(p))) for f, notice in TEMPLATES]


def covering(own: list[str]) -> dict[str, float]:
    """For each family the largest share of one of its notices' word pairs that the paragraph has."""
    have = PAIRS.intersection(pairwise(own))
    out: dict[str, float] = {}
    for family, body in BODIES:
        out[family] = max(out.get(family, 0.0), len(body & have) / len(body))
    return out


def passages(own: list[str]) -> list[tuple[int, int]]:
    """Stretches (start, end) of words to be judged; a lone pair can confirm no notice and has none."""
    hits = [k for k, p in enumerate(pairwise(own)) if p in PAIRS]
    out: dict[tuple[int, int], None] = {}
    for gap in GAPS:
        first = 0
        for k in range(1, len(hits) + 1):
            if k == len(hits) or hits[k] - hits[k - 1] > gap:
                start, end = hits[first], hits[k - 1] + 2
                if k - first > 1:
                    steps = range(start, max(start + 1, end - WINDOW // 2), WINDOW // 2)
                    out.update(dict.fromkeys((at, min(end, at + WINDOW)) for at in steps))
                first = k
    return list(out)


def blocks(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """Words of each run of lines with words, and the number of each word's line among those not blank."""
    own: list[str] = []
    at: list[int] = []
    n = 0
    for line in text.split("\n"):
        found = words(line)
        if found:
            own += found
            at += [n] * len(found)
        elif own:
            yield own, at
            own, at = [], []
        n += bool(line.strip())
    if own:
        yield own, at


@dataclass
class Model:
    weights: np.ndarray  # n-grams and an offset by families
    threshold: float = 0.5

    def probabilities(self, found: list[list[int]], sizes: list[int]) -> np.ndarray:
        z = np.tile(self.weights[-1], (len(found), 1))
        for k, (own, n) in enumerate(zip(found, sizes, strict=True)):
            if own:
                z[k] += self.weights[own].sum(axis=0) / np.sqrt(max(1, n))
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)

    def against_unknown(self, p: np.ndarray) -> np.ndarray:
        """Probability of each family where only it and "unknown" are possible."""
        return p[:, :-1] / (p[:, :-1] + p[:, -1:] + 1e-30)


def varied(seed: int = 3, each: int = 60) -> list[tuple[list[str], int]]:
    """Training paragraphs made of the notices, and unknown ones made of their words in disorder."""
    draw = np.random.default_rng(seed)
    every = [w for notices in NOTICES.values() for n in notices for w in words(n)]
    out = []
    for k, family in enumerate(NOTICES):
        for notice in NOTICES[family]:
            own = words(notice)
            out += [(own, k)] * 5
            for _ in range(each):
                kept = [w for w in own if w.isdigit() or draw.random() > 0.06]
                other = [f"w{draw.integers(1000)}" for _ in range(draw.integers(0, 12))]
                cut = int(draw.integers(0, len(other) + 1))
                out.append((other[:cut] + kept + other[cut:], k))
    for _ in range(len(out) // 2):
        n = int(draw.integers(1, 25))
        mixed = [every[i] if draw.random() < 0.6 else f"w{draw.integers(1000)}" for i in draw.integers(0, len(every), n)]
        out.append((mixed, len(NOTICES)))
    return out


def near_misses(seed: int, each: int = 20) -> list[list[str]]:
    """Passages close to notices that are none: short pieces, pieces of two families, disorder."""
    draw = np.random.default_rng(seed)
    notices = [words(n) for own in NOTICES.values() for n in own]

    def piece(own: list[str], share: float) -> list[str]:
        n = max(2, int(len(own) * share))
        at = int(draw.integers(0, max(1, len(own) - n + 1)))
        return own[at : at + n]

    out = []
    for own in notices:
        for _ in range(each):
            noise = [f"w{draw.integers(1000)}" for _ in range(draw.integers(0, 8))]
            out.append(noise + piece(own, 0.4))
            out.append(piece(own, 0.4) + noise + piece(notices[draw.integers(len(notices))], 0.4))
            out.append([own[k] for k in draw.permutation(len(own))])
    return [p for p in out if max(covering(p).values()) < 0.5]


def fit(unknown: list[list[str]], allowed: float = ALLOWED, steps: int = 800, rate: float = 0.5, decay: float = 1e-5) -> Model:
    """Full-batch descent on the notices' variants, near misses and four in five unknown passages."""
    kept_out = [p for p in unknown if xxhash.xxh3_64_intdigest(" ".join(p).encode()) % 5 == 0]
    given = near_misses(seed=11) + [p for p in unknown if xxhash.xxh3_64_intdigest(" ".join(p).encode()) % 5]
    rows = varied() + [(p, len(NOTICES)) for p in given]
    y = np.array([k for _, k in rows])
    found = [grams(p) for p, _ in rows]
    scale = np.repeat([1 / np.sqrt(max(1, len(p))) for p, _ in rows], [len(f) for f in found])
    row, column = np.repeat(np.arange(len(rows)), [len(f) for f in found]), np.array([g for f in found for g in f], int)
    x = np.zeros((len(rows), len(GRAMS) + 1), np.float32)
    np.add.at(x, (row, column), scale)
    x[:, -1] = 1
    share = np.bincount(y, minlength=len(FAMILIES))
    weight = (1 / share[y])[:, None] / len(FAMILIES)
    weight = weight.astype(np.float32)
    w, speed = np.zeros((2, x.shape[1], len(FAMILIES)), np.float32)
    target = np.eye(len(FAMILIES), dtype=np.float32)[y]
    for _ in range(steps):
        z = x @ w
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - rate * (x.T @ ((p - target) * weight) * len(FAMILIES) + decay * w)
        w += speed
    model = Model(w)
    thresholds = []
    for own in (kept_out, near_misses(seed=12)):
        if own:
            p = model.probabilities([grams(k) for k in own], [len(k) for k in own])
            best = model.against_unknown(p).max(axis=1)
            thresholds.append(float(np.quantile(best, 1 - allowed, method="higher")) + 1e-9)
    model.threshold = max(thresholds)
    return model


def lines_of(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip()]


def notices_of(own: list[str], spans: list[tuple[int, int]], p: np.ndarray, q: np.ndarray, threshold: float) -> tuple[list, int]:
    """Confirmed notices of a block (first word, family, probability, cover) and the number of passages
    that pass the threshold without one.

    `p` holds the probabilities of all families, `q` those against "unknown" alone.
    """
    rows, unsure = [], 0
    for (start, end), full, alone in zip(spans, p, q, strict=True):
        passing = np.flatnonzero(alone >= threshold)
        if not len(passing):
            continue
        at: dict[tuple[str, str], set[int]] = {}
        for k in range(start, end - 1):
            if (own[k], own[k + 1]) in PAIRS:
                at.setdefault((own[k], own[k + 1]), set()).add(k)
        confirmed = 0
        for family in passing:
            cover, body = max(
                ((len(b & at.keys()) / len(b), b) for f, b in BODIES if f == FAMILIES[family]), key=lambda x: (x[0], len(x[1]))
            )
            if cover >= COVER:
                confirmed += 1
                places = set().union(*(at[x] for x in body & at.keys()))
                rows.append((-float(full[family]), -cover, min(places), FAMILIES[family], float(alone[family]), places))
        unsure += not confirmed
    out, taken = [], set()
    for _, cover, first, family, probability, places in sorted(rows, key=lambda r: r[:4]):
        if not places <= taken:
            if not any(f == family and places & other for _, f, _, _, other in out):
                out.append((first, family, probability, -cover, places))
            taken |= places
    return sorted(r[:4] for r in out), unsure


def train(docs: DataFrame, sample: int = SAMPLE, **options: float) -> Model:
    """Unknown passages come from the corpus: from the lines with the smallest hashes, one each, which
    covers no template; it is whole, as a passage has at most `WINDOW` words.

    Lines are counted first, and only hashes below a bound that twice the sample lies under are
    looked at, so what tasks send does not grow with their number.
    """
    lines = docs.agg(F.sum(F.size(F.split(docs["text"].cast("string"), "\n", -1)))).first()[0] or 0
    bound = below(lines, sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, list[str]] = {}
        highest = bound
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                for line in lines_of(text):
                    draw = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"), seed=5) - 2**63
                    if draw < highest and draw not in out:
                        own = words(line)
                        drawn = [own[a:b] for a, b in passages(own)]
                        drawn = [p for p in drawn if max(covering(p).values()) < 0.3]
                        if drawn:
                            out[draw] = min(drawn, key=lambda p: xxhash.xxh3_64_intdigest(" ".join(p)))
            if len(out) > 2 * sample:
                out = dict(sorted(out.items())[:sample])
                highest = max(out)
        best = sorted(out.items())[:sample]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in best], pa.int64()), pa.array([v for _, v in best], pa.list_(pa.string()))],
            ["draw", "words"],
        )

    found = texts(docs).mapInArrow(run, "draw long, words array<string>")
    rows = found.groupBy("draw").agg(F.min("words").alias("words")).orderBy("draw").limit(sample).collect()
    return fit([list(r["words"]) for r in sorted(rows, key=lambda r: r["draw"])], **options)


def scan(docs: DataFrame, model: Model | None = None, **training: float) -> DataFrame:
    """(doc_id, n_paragraphs, n_unconfirmed, families, found): found lists line, family, probability, cover."""
    model = model or train(docs, **training)
    kind = pa.list_(pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("cover", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, unsure, found, place, judged = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                counts.append(len(lines_of(text)))
                unsure.append(0)
                found.append([])
                for own, at in blocks(text):
                    spans = passages(own)
                    if spans:
                        place.append((k, own, at, spans))
                        judged += [own[a:b] for a, b in spans]
            if place:
                p = model.probabilities([grams(w) for w in judged], [len(w) for w in judged])
                q, done = model.against_unknown(p), 0
                for k, own, at, spans in place:
                    part = slice(done, done + len(spans))
                    done += len(spans)
                    notices, alone = notices_of(own, spans, p[part], q[part], model.threshold)
                    unsure[k] += alone
                    found[k] += [dict(zip(("line", "family", "probability", "cover"), (at[f], *r), strict=True)) for f, *r in notices]
            columns = pa.array(counts, pa.int64()), pa.array(unsure, pa.int64()), pa.array(found, kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_paragraphs", "n_unconfirmed", "found"])

    rows = texts(docs).mapInArrow(
        run,
        "doc_id long, n_paragraphs long, n_unconfirmed long, "
        "found array<struct<line:long,family:string,probability:double,cover:double>>",
    )
    families = F.array_sort(F.array_distinct(F.transform("found", lambda s: s["family"])))
    return rows.select("doc_id", "n_paragraphs", "n_unconfirmed", families.alias("families"), "found")
