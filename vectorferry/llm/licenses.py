"""Licence scans: a trained paragraph classifier, confirmed by templates.

Every line of a text, and every window of words whatever lines and comment marks it
spans, gets a score per licence family from a sparse logistic regression on its words
and word pairs, trained here on variations of licence notices against paragraphs of the
corpus, which stand for the unknown class. The scores are calibrated on held-out
examples; it proposes families for every line and window, and a proposal counts only if the
line or window also holds enough of one of the family's templates. Of candidates that overlap, the one that holds most counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm import kernels
from vectorferry.llm.decontaminate import punctuation

UNKNOWN = "unknown"
FEATURE_BITS = 16
WINDOW = 64  # words; windows overlap by half, so notices of up to half a window are whole in one

# Short licence notices by family.
TEMPLATES: dict[str, list[str]] = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
}


@dataclass(frozen=True)
class Model:
    """Weights per feature and family (the last column is the unknown class), a temperature, and templates."""

    families: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: tuple[tuple[int, np.ndarray, int], ...]  # family, sorted hashes of its words and word pairs, words


class Paragraphs:
    """Features of the paragraphs (lines) of texts: hashes of words and of pairs of neighbours."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, codes, powers, separators):
        self.words = kernels.Words(data, offsets, codes, powers, separators)
        # last byte of each paragraph
        self.edges = np.unique(np.concatenate([np.flatnonzero(data == 10), offsets[1:] - 1]))
        self.line = np.searchsorted(self.edges, self.words.starts, side="left")
        pair = (self.words.hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + self.words.hashes[1:])
        near = self.line[:-1] == self.line[1:]
        pair = kernels.mix64(pair)
        pairs, of = pair[near], self.line[:-1][near]
        self.hashes = np.concatenate([self.words.hashes, pairs])
        self.owner = np.concatenate([self.line, of])
        self.pair, self.near = pair, self.words.owner[:-1] == self.words.owner[1:]  # of a word and the next

    def windows(self) -> Windows:
        """The windows of whole texts, each of two neighbouring blocks of half a window."""
        step, words = WINDOW // 2, self.words
        blocks = -(-words.counts // step)
        number = np.maximum(blocks - 1, np.minimum(blocks, 1))
        head, top = np.concatenate([[0], np.cumsum(blocks)]), np.concatenate([[0], np.cumsum(number)])
        of = np.repeat(np.arange(len(number)), number)
        at = np.arange(len(of)) - top[of]
        start = words.first[of] + at * step
        end = np.minimum(start + WINDOW, words.first[of] + words.counts[of])
        block = head[words.owner] + (np.arange(len(words.hashes)) - words.first[words.owner]) // step
        inside, over = self.near & (block[:-1] == block[1:]), self.near & (block[:-1] != block[1:])
        return Windows(
            np.concatenate([words.hashes, self.pair[inside]]), np.concatenate([block, block[:-1][inside]]),
            self.pair[over], block[:-1][over], head[of] + at, blocks[of] > 1, start, end, int(head[-1]))


@dataclass(frozen=True)
class Windows:
    """Features by block, and those of a block's last word and the next one, by the first of the two.

    A window has the features of block ``first``, and if it is ``double`` of the next and the one between.
    """

    hashes: np.ndarray
    block: np.ndarray
    between: np.ndarray
    between_block: np.ndarray
    first: np.ndarray
    double: np.ndarray
    start: np.ndarray
    end: np.ndarray
    blocks: int

    def spread(self, kept: np.ndarray, kept_between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of features in ``hashes`` followed by ``between``, and the window of each."""
        head, tail = np.full(self.blocks, -1), np.full(self.blocks, -1)
        head[self.first] = np.arange(len(self.first))
        tail[self.first[self.double] + 1] = np.flatnonzero(self.double)
        far = len(self.hashes) + kept_between
        place = np.concatenate([kept, kept, far])
        window = np.concatenate([head[self.block[kept]], tail[self.block[kept]], head[self.between_block[kept_between]]])
        return place[window >= 0], window[window >= 0]


def _tables():
    return kernels.byte_codes(), kernels.Powers(), kernels.separator_table(punctuation())


def _encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(raw), np.uint8),
            np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def _features(text: str, tables) -> np.ndarray:
    return np.unique(Paragraphs(*_encode([text.replace("\n", " ")]), *tables).hashes)


def _length(text: str, tables) -> int:
    return len(Paragraphs(*_encode([text]), *tables).words.hashes)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted, each once; numbers sort faster than they hash."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def _run(lines: list[str], rng: np.random.Generator, count: int) -> list[str]:
    """``count`` words of lines drawn from the corpus, fewer if these are short."""
    out: list[str] = []
    for i in rng.integers(0, len(lines), 16) if lines and count else []:
        out += lines[i].split()[: count - len(out)]
    return out


def _variations(text: str, fill: np.ndarray, rng: np.random.Generator, count: int, around: list[str]) -> list[str]:
    """The notice as it is, with a few words or running text around it, and with a few words left out."""
    out = [text]
    while len(out) < count:
        words = text.split()
        if len(words) > 5 and rng.random() < 0.4:
            words = [w for w in words if rng.random() > 0.1]
        if len(out) % 2:
            room = max(0, WINDOW - len(words))
            left = int(rng.integers(0, room + 1))
            before, after = _run(around, rng, left), _run(around, rng, room - left)
        else:
            before, after = (rng.choice(fill, rng.integers(0, 5)).tolist() if len(fill) else [] for _ in range(2))
        out.append(" ".join([*before, *words, *after]))
    return out


def train(docs: DataFrame, text_column: str = "text", most_rows: int = 2_000, each: int = 60, epochs: int = 30,
          seed: int = 5) -> Model:
    """Fit the regression on the driver, on a bounded sample.

    About ``most_rows`` distinct paragraphs of the corpus, chosen by their hashes, stand
    for the unknown class, alone and in windows, and lend words and running text to
    surround notices with; lines of over 2,000 characters are drawn in pieces of that
    length. ``each`` variations of each notice stand for its family. A fifth is held out to choose the temperature
    that makes the probabilities fit best.
    """
    whole = docs.select(F.explode(F.split(text_column, "\n")).alias("line")).filter("length(line) > 0")
    lines = whole.select(F.explode(F.expr(
        "case when length(line) <= 2000 then array(line)"
        " else transform(sequence(1, length(line), 2000), i -> substring(line, i, 2000)) end")).alias("line"))
    part = most_rows / max(most_rows, lines.count())  # each task then sends its share only
    drawn = lines.filter(F.pmod(F.xxhash64("line"), F.lit(1 << 40)) < int(part * (1 << 40))).distinct()
    first = drawn.orderBy(F.xxhash64("line"), "line").limit(2 * most_rows)
    sample = sorted(r[0] for r in first.collect())
    families = tuple(sorted(TEMPLATES))
    rng = np.random.default_rng(seed)
    fill = np.array(sorted({w for line in sample for w in line.split()}))
    tables = _tables()
    known = tuple((k, _features(t, tables), _length(t, tables)) for k, f in enumerate(families) for t in TEMPLATES[f])
    if max(n for _, _, n in known) > WINDOW // 2:
        raise ValueError(f"a notice has more than {WINDOW // 2} words, so no window need hold it whole")
    clean = []
    for line in sample:
        found = _features(line, tables)
        if not any(_held(found, t) >= 0.6 for _, t, _ in known):  # a notice in the sample is no unknown
            clean.append(line)
    texts, labels = [], []
    for k, family in enumerate(families):
        for notice in TEMPLATES[family]:
            for text in _variations(notice, fill, rng, each, clean):
                texts.append(text)
                labels.append(k)
    for line in [*clean, *(" ".join(_run(clean, rng, WINDOW)) for _ in range(len(clean) // 4))]:
        texts.append(line)
        labels.append(len(families))
    rows = [np.unique(_bucket(_features(t, tables))) for t in texts]
    label = np.array(labels)
    weights, bias = np.zeros((1 << FEATURE_BITS, len(families) + 1)), np.zeros(len(families) + 1)
    squares, held_out = np.full_like(weights, 1e-8), rng.random(len(rows)) < 0.2
    learned = np.flatnonzero(~held_out)
    for _ in range(epochs):
        for i in rng.permutation(learned):
            at = rows[i]
            error = _softmax(weights[at].sum(axis=0) + bias)
            error[label[i]] -= 1
            squares[at] += error * error
            weights[at] -= 0.5 * error / np.sqrt(squares[at])
            bias -= 0.02 * error
    logits = np.array([weights[rows[i]].sum(axis=0) + bias for i in np.flatnonzero(held_out)]).reshape(-1, len(bias))
    truth = label[held_out]

    def loss(temperature: float) -> float:
        chance = _softmax(logits / temperature)
        return -float(np.log(np.maximum(chance[np.arange(len(truth)), truth], 1e-12)).mean()) if len(truth) else 0.0

    temperature = min((1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0), key=loss)
    return Model(families, weights.astype(np.float32), bias.astype(np.float32), temperature, known)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _held(features: np.ndarray, template: np.ndarray) -> float:
    """Share of a template's words and pairs that a paragraph holds."""
    return float(np.isin(template, features).mean()) if len(template) else 0.0


class _Scorer:
    """Logits of lines and windows, and the shares of templates that they hold."""

    def __init__(self, model: Model):
        self.model = model
        # features that tell families apart; others move none of them
        self.touched = np.abs(model.weights[:, :-1] - model.weights[:, -1:]).max(axis=1) > 1e-6
        self.keys = np.unique(np.concatenate([t for _, t, _ in model.templates]))
        self.maybe = np.zeros(1 << FEATURE_BITS, bool)
        self.maybe[_bucket(self.keys)] = True
        self.member = np.array([np.isin(self.keys, t) for _, t, _ in model.templates])
        self.family = np.array([k for k, _, _ in model.templates])
        self.size = np.array([len(t) for _, t, _ in model.templates])

    def _sums(self, keys: np.ndarray, units: int) -> np.ndarray:
        """Weights added up per unit over ``(unit, bucket)`` keys in order."""
        total = np.zeros((units, self.model.weights.shape[1]), np.float64)
        unit = keys >> FEATURE_BITS
        new = np.ones(len(unit), bool)
        new[1:] = unit[1:] != unit[:-1]
        first = np.flatnonzero(new)
        if len(first):
            total[unit[first]] = np.add.reduceat(self.model.weights[keys & ((1 << FEATURE_BITS) - 1)], first, axis=0)
        return total

    def _chances(self, logits: np.ndarray) -> np.ndarray:
        return _softmax((logits + self.model.bias) / self.model.temperature)

    def _keys(self, hashes: np.ndarray, unit: np.ndarray) -> np.ndarray:
        bucket = _bucket(hashes)
        used = self.touched[bucket]
        return (unit[used] << FEATURE_BITS) + bucket[used]

    def lines(self, hashes: np.ndarray, owner: np.ndarray, units: int) -> np.ndarray:
        """Probabilities per line; each feature of a line counts once."""
        return self._chances(self._sums(_distinct(self._keys(hashes, owner)), units))

    def windows(self, w: Windows) -> np.ndarray:
        """Probabilities per window; each feature of a window counts once.

        The sums of its blocks, less those of features that both have, and the pair between
        them if neither has it: a feature is so looked at once and not once per window.
        """
        keys, step = _distinct(self._keys(w.hashes, w.block)), 1 << FEATURE_BITS
        paired = np.zeros(w.blocks + 1, bool)  # blocks that stand first in a double window
        paired[w.first[w.double]] = True
        of = self._sums(keys, w.blocks + 1)
        both = np.sort(np.concatenate([keys, keys[paired[keys >> FEATURE_BITS]] + step]))
        both = both[1:][both[1:] == both[:-1]] - step
        joint = self._sums(both, w.blocks + 1)
        between = np.sort(self._keys(w.between, w.between_block))
        for other in (keys, keys - step):
            at = np.minimum(np.searchsorted(other, between), max(0, len(other) - 1))
            between = between[other[at] != between] if len(other) else between
        extra = self._sums(between, w.blocks + 1)
        logits, first, second = of[w.first], w.first[w.double], w.first[w.double] + 1
        logits[w.double] += of[second] - joint[first] + extra[first]
        return self._chances(logits)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Places of features that templates have."""
        some = np.flatnonzero(self.maybe[_bucket(hashes)])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
        return some[self.keys[at] == hashes[some]]

    def shares(self, hashes: np.ndarray, unit: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The share of each template that the ``asked`` units (ascending) hold, by known features and their units."""
        row = np.minimum(np.searchsorted(asked, unit), max(0, len(asked) - 1))
        mine = asked[row] == unit if len(asked) else np.zeros(len(unit), bool)
        pair = _distinct(row[mine] * len(self.keys) + np.searchsorted(self.keys, hashes[mine]))
        row, key = pair // len(self.keys), pair % len(self.keys)
        counts = [np.bincount(row[m[key]], minlength=len(asked)) for m in self.member]
        return np.array(counts).T / self.size


def _span(words: np.ndarray, pairs: np.ndarray, template: np.ndarray, length: int) -> tuple[float, int, int]:
    """The largest share of a template within one and a half times its words, and the first and
    last word that it has there; ``pairs`` are of each word and the next."""
    wide = length + (length + 1) // 2
    place = np.searchsorted(template, np.concatenate([words, pairs])).clip(max=len(template) - 1)
    here = template[place] == np.concatenate([words, pairs])
    at = np.concatenate([np.arange(len(words)), np.arange(len(pairs))])[here]
    end = np.concatenate([np.arange(len(words)) + 1, np.arange(len(pairs)) + 2])[here]
    place = place[here]
    best = (0.0, 0, 0)
    for start in np.unique(at).tolist():
        inside = (at >= start) & (end <= start + wide)
        share = len(np.unique(place[inside])) / len(template)
        if share > best[0]:
            best = (share, start, int(end[inside].max()))
    return best


def _scan_task(model: Model, least: float, confirmed: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, scorer = _tables(), _Scorer(model)
        for rows, data, offsets in kernels.chunks(batches):
            found = Paragraphs(data, offsets, *tables)
            # text, share of a template, whether a window, family, probability, first and last word
            candidates: list[tuple[int, float, bool, int, float, int, int]] = []

            def confirm(family: int, p: float, shares: np.ndarray, a: int, b: int, window: bool) -> None:
                """Keep the span of a proposed family if the line or window holds enough of a template."""
                words, pairs = found.words.hashes[a:b], found.pair[a: b - 1]
                held = [t for t in np.flatnonzero(scorer.family == family) if shares[t] >= confirmed - 1e-9]
                if held and not window:
                    held = [max(held, key=lambda t: shares[t])]
                spans = [_span(words, pairs, *model.templates[t][1:]) for t in held]
                share, begin, end = max(spans, key=lambda x: x[0], default=(0.0, 0, 0))
                share = share if window or not held else float(shares[held[0]])
                if share >= confirmed - 1e-9:
                    candidates.append((int(found.words.owner[a]), share, window, family, p, a + begin, a + end))

            chance = scorer.lines(found.hashes, found.owner, len(found.edges))
            pick = chance.argmax(axis=1)
            sure = chance[np.arange(len(pick)), pick]
            lines = np.flatnonzero((pick < len(model.families)) & (sure >= least))
            at = scorer.known(found.hashes)
            shares = scorer.shares(found.hashes[at], found.owner[at], lines)
            begins, ends = (np.searchsorted(found.line, lines, side) for side in ("left", "right"))
            for i in np.flatnonzero((shares >= confirmed - 1e-9).any(axis=1)).tolist():
                line = lines[i]
                confirm(int(pick[line]), float(sure[line]), shares[i], int(begins[i]), int(ends[i]), False)

            windows = found.windows()
            chance = scorer.windows(windows)
            # a window may hold notices of several families, so each is judged against the unknown class alone
            sure = chance[:, :-1] / (chance[:, :-1] + chance[:, -1:])
            proposed = np.flatnonzero((sure >= least).any(axis=1))
            features = np.concatenate([windows.hashes, windows.between])
            at, window = windows.spread(scorer.known(windows.hashes), scorer.known(windows.between))
            shares = scorer.shares(features[at], window, proposed)
            for i in np.flatnonzero((shares >= confirmed - 1e-9).any(axis=1)).tolist():
                place = proposed[i]
                for family in np.flatnonzero(sure[place] >= least).tolist():
                    confirm(family, float(sure[place, family]), shares[i], int(windows.start[place]),
                            int(windows.end[place]), True)
            taken: dict[int, list[tuple[int, int]]] = {}
            out: list[tuple[int, int, int, str, float, float]] = []
            for text, share, _, family, p, a, b in sorted(candidates, key=lambda c: (-c[1], c[2], -c[4], c[3], c[5])):
                if all(b <= x or y <= a for x, y in taken.get(text, [])):
                    taken.setdefault(text, []).append((a, b))
                    place = int((data[offsets[text]: found.words.starts[a]] == 10).sum())
                    out.append((text, place, family, model.families[family], p, share))
            out.sort()
            edges = np.searchsorted([o[0] for o in out], np.arange(rows.num_rows + 1)).astype(np.int32)
            found_lines = pa.StructArray.from_arrays([
                pa.array([o[1] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.string()),
                pa.array([o[4] for o in out], pa.float64()), pa.array([o[5] for o in out], pa.float64()),
            ], names=["line", "family", "probability", "held"])
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.ListArray.from_arrays(edges, found_lines)], names=["id", "found"])
    return run


def scan_licenses(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
                  least: float = 0.5, confirmed: float = 0.6) -> DataFrame:
    """``(id_column, license, found)`` of each row.

    ``found`` has ``(line, family, probability, held)`` of the lines and windows whose family is
    at least ``least`` likely and of one of whose templates they hold ``confirmed``, each
    notice once; lines count from 0, and a notice over several has its first. A window's
    probability is that of the family against the unknown class. ``license`` is the family found with the largest probability,
    then the first by name; ``unknown`` if there is none, also for null and empty
    texts. Each row has its own result, also if rows repeat or have a null id. Other
    columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scanned = rows.mapInArrow(
        _scan_task(model, least, confirmed),
        f"id {kind}, found array<struct<line: long, family: string, probability: double, held: double>>")
    best = F.array_min(F.transform("found", lambda x: F.struct((-x["probability"]).alias("p"), x["family"])))
    return scanned.select(
        F.col("id").alias(id_column), F.coalesce(best["family"], F.lit(UNKNOWN)).alias("license"), "found")
