"""Licence scan by a trained paragraph classifier.

A document is cut into units: its lines, and in longer lines windows of 32 words at every
16. What no line confirms is cut again as paragraphs: words between blank lines or confirmed
notices, in the same windows across single line breaks, so hard-wrapped notices are found too;
this is repeated beside what it confirms until nothing more is found. A multinomial logistic regression over word uni- and bigrams, sparse and
hashed, gives each unit a licence family or the unknown class. It is trained here on
variants of the notices below (words left out, ordinary words around them) against
units of a bounded sample of the corpus and loose pieces of notices, which stand for
the unknown class; a temperature fitted on variants kept apart calibrates the
probabilities. A predicted family counts only if a comparison with its notices confirms it:
enough of a notice's word pairs must stand in the unit.

Defined cases: null, empty and wordless texts have no units and no licence (family
null, score 0); a family that stands several times counts once in `families` and
every time in n_confirmed; without any corpus sample the unknown class is trained on loose pieces alone; other columns
pass through (result columns win on clashing names).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_texts
from ._text import LETTER_DIGIT, LOWER, NOT_SPACE, U64, buffer_of, mix, span_hash, text_batches, word_spans

#: Short public notices of licence families.
NOTICES = {
    "agpl-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.", "You may redistribute it under the terms of the GNU Affero General Public License version 3 or later."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "This project is released under the Apache 2.0 license."],
    "bsd-2-clause": ["Licensed under the BSD 2-Clause License.", "This software is released under the simplified BSD license."],
    "bsd-3-clause": ["Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Released under the terms of the GNU GPL v2."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Released under the terms of the GNU GPL v3.", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License."],
    "isc": ["Licensed under the ISC License."],
    "lgpl-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}
UNIT, STEP = 32, 16
VARIANTS = 60
#: Corpus documents whose units may train the unknown class.
SAMPLE_DOCS = 400
#: Share of a notice's word pairs that a unit must hold.
CONFIRM = 0.6
#: What training takes of its sample: documents of so many bytes at most, and of each so many lines and ordinary words, at even steps.
SAMPLE_TEXT_BYTES, LINES_OF_TEXT, WORDS_OF_TEXT = 1 << 16, 20, 100
BATCH_BYTES = 4 << 20
_SEED = U64(0x9E3779B97F4A7C15)


def _windows(group: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and last word + 1 of the windows over runs of used words of equal group."""
    at = np.flatnonzero(use)
    if not len(at):
        return at, at
    new = np.append(True, (group[at[1:]] != group[at[:-1]]) | (np.diff(at) > 1))
    start = at[new]
    size = np.diff(np.append(np.flatnonzero(new), len(at)))
    n = np.maximum(1, -(-(size - UNIT) // STEP) + 1)
    first = np.repeat(start, n) + (np.arange(int(n.sum())) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)) * STEP
    return first, np.minimum(first + UNIT, np.repeat(start + size, n))


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(hashes, begins, ends, line, paragraph, document) of each word; lines and paragraphs are numbered through the batch."""
    begins, ends, first = word_spans(data, offsets, LETTER_DIGIT)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    text = data[: int(offsets[-1])]
    breaks = np.flatnonzero(text == 10)
    filled = np.concatenate([[0], np.cumsum(NOT_SPACE[text])])[breaks]
    blank = breaks[1:][filled[1:] == filled[:-1]]
    line, paragraph = np.searchsorted(breaks, begins), np.searchsorted(blank, begins)
    return span_hash(data, begins, ends), begins, ends, line + doc, paragraph + doc, doc


def grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix(words ^ U64(1)), mix(words[:-1] * _SEED + words[1:])


@dataclass
class LicenceModel:
    families: list[str]
    keys: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    notices: list[list[np.ndarray]]

    def __post_init__(self):
        self.maybe = np.zeros(1 << 18, dtype=bool)
        self.maybe[(self.keys >> U64(46)).astype(np.int64)] = True

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.maybe[(hashes >> U64(46)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[slot] == hashes[at]
        return at[same], slot[same]

    def units(self, words: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(units that hold a known gram, their class probabilities; the last class is unknown)."""
        hits: list[np.ndarray] = []
        for width, hashes in enumerate(grams(words), 1):
            place, slot = self._known(hashes)
            # A word lies in at most two windows: the last that starts before it, and the one before that.
            u = np.searchsorted(at, place, side="right") - 1
            for v in (u, u - 1):
                good = (v >= 0) & (place + width <= stop[np.maximum(v, 0)])
                hits.append(np.stack([v[good], slot[good]]))
        unit, slot = np.concatenate(hits, axis=1)
        both = np.unique(unit * len(self.keys) + slot)  # presence, not counts
        unit, slot = both // len(self.keys), both % len(self.keys)
        some, row = np.unique(unit, return_inverse=True)
        z = np.tile(self.bias, (len(some), 1))
        np.add.at(z, row, self.weights[slot])
        return some, softmax(z / self.temperature)

    def confirms(self, family: int, words: np.ndarray) -> tuple[int, int] | None:
        """First word and last word + 1 of the notice that the words hold most of, if that is enough: of its first full copy."""
        own = grams(words)[1]
        share, best = max((float(np.isin(n, own).mean()), -k) for k, n in enumerate(self.notices[family]))
        if share < CONFIRM:
            return None
        notice = self.notices[family][-best]
        held = np.flatnonzero(np.isin(own, notice))
        copies = [held[i : np.searchsorted(held, x + len(notice) + 2)] for i, x in enumerate(held.tolist())]
        copy = max(copies, key=lambda c: len(np.unique(own[c])))
        pairs, at = np.unique(own[copy], return_index=True)
        held = copy[: at.max() + 1] if len(pairs) >= CONFIRM * len(notice) else held
        return int(held[0]), int(held[-1]) + 2


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True) if len(z) else e


def _hash_words(text: str) -> np.ndarray:
    data, offsets = buffer_of(pa.array([text]))
    data = LOWER[data]
    begins, ends, _ = word_spans(data, offsets, LETTER_DIGIT)
    return span_hash(data, begins, ends)


def _evenly(items: list, most: int) -> list:
    """About `most` of the items, at even steps from first to last."""
    return items[:: max(1, -(-len(items) // most))]


def train(corpus: list[str], seed: int = 0) -> LicenceModel:
    """Fit the classifier on variants of the notices and on units of corpus texts."""
    rng = np.random.default_rng(seed)
    families = sorted(NOTICES)
    ordinary = [w for t in corpus for w in _evenly(t.split(), WORDS_OF_TEXT)] or ["text"]
    notices = [grams(_hash_words(n))[1] for f in families for n in NOTICES[f]]

    def around() -> list[str]:
        return [ordinary[i] for i in rng.integers(0, len(ordinary), rng.integers(0, 12))]

    rows: list[tuple[np.ndarray, int]] = []
    for k, family in enumerate(families):
        for notice in NOTICES[family]:
            words = notice.split()
            for v in range(VARIANTS):
                kept = [w for w in words if not v or rng.random() > 0.05]
                rows.append((_hash_words(" ".join([*around(), *kept, *around()])), k))
                loose = rng.integers(0, max(1, len(words) - 2))
                if v % 3 == 0:  # two words of a notice say nothing yet
                    rows.append((_hash_words(" ".join([*around(), *words[loose : loose + 2], *around()])), len(families)))
    for text in corpus:
        for line in _evenly(text.split("\n"), LINES_OF_TEXT):
            words = line.split()
            at = int(rng.integers(0, max(1, len(words) - UNIT + 1)))
            unit = _hash_words(" ".join(words[at : at + UNIT]))
            pairs = grams(unit)[1]
            # Lines that speak of licences are just what the unknown class is for; only those that hold a notice are none.
            if max(float(np.isin(n, pairs).mean()) for n in notices) < CONFIRM / 2:
                rows.append((unit, len(families)))
    order = rng.permutation(len(rows))
    rows = [rows[i] for i in order]
    y = np.array([r[1] for r in rows])
    wanted = np.unique(np.concatenate([g for f in NOTICES.values() for n in f for g in grams(_hash_words(n))]))
    x = np.zeros((len(rows), len(wanted)), dtype=np.float32)
    for i, (words, _) in enumerate(rows):
        for g in grams(words):
            x[i, np.searchsorted(wanted, g[np.isin(g, wanted)])] = 1
    cut = len(rows) * 4 // 5
    w, b = np.zeros((len(wanted), len(families) + 1), dtype=np.float32), np.zeros(len(families) + 1, dtype=np.float32)
    gold = np.eye(len(families) + 1, dtype=np.float32)[y[:cut]]
    sw, sb = np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    for _ in range(150):
        miss = (softmax(x[:cut] @ w + b) - gold) / cut
        gw, gb = x[:cut].T @ miss + 2e-5 * w, miss.sum(axis=0)
        sw += gw * gw
        sb += gb * gb
        w -= 0.3 * gw / np.sqrt(sw)
        b -= 0.3 * gb / np.sqrt(sb)
    z = x[cut:] @ w + b
    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=lambda t: -np.log(softmax(z / t)[np.arange(len(z)), y[cut:]] + 1e-12).mean()) if len(z) else 1.0
    return LicenceModel(families, wanted, w, b, temperature, [[grams(_hash_words(n))[1] for n in NOTICES[f]] for f in families])


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, text_bytes: int = SAMPLE_TEXT_BYTES) -> LicenceModel:
    """Train against a sample of about sample_docs documents of at most text_bytes each, the same at every run."""
    texts = docs.select("doc_id", "text").filter(F.octet_length("text") <= text_bytes)
    share = min(1.0, sample_docs / max(1, texts.count()))
    rows = texts.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit(6)), F.lit(1 << 20)) < share * (1 << 20)).limit(4 * sample_docs).collect()
    return train([r.text for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text))])


def scan(docs: DataFrame, model: LicenceModel, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Each row with family, score, n_confirmed, n_unconfirmed, families and spans (byte offsets)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        unknown = len(own.families)
        for batch in text_batches(batches, text_col, BATCH_BYTES):
            data, offsets = buffer_of(batch.column(text_col))
            words, begins, ends, line, paragraph, doc = words_of(LOWER[data], offsets)
            n = batch.num_rows
            hits: list[list[tuple[int, int, int, float]]] = [[] for _ in range(n)]
            loose: list[list[tuple[int, int]]] = [[] for _ in range(n)]
            taken = np.full(len(words), -1)  # the family that a word was confirmed for

            def predicted(at: np.ndarray, stop: np.ndarray) -> list[tuple[int, int, int, float]]:
                some, p = own.units(words, at, stop) if len(words) > 1 and len(at) else (np.zeros(0, np.int64), np.zeros((0, unknown + 1)))
                top = p.argmax(axis=1) if len(p) else some
                good = top < unknown
                return list(zip(at[some[good]].tolist(), stop[some[good]].tolist(), top[good].tolist(), p[good, top[good]].tolist(), strict=True))

            for x, y, k, p in predicted(*_windows(line, taken < 0)):
                if own.confirms(k, words[x:y]):
                    hits[doc[x]].append((x, y, k, p))
                    taken[x:y] = k
                else:
                    loose[doc[x]].append((x, y))
            active = np.ones(n, dtype=bool)
            while active.any():
                at, stop = _windows(paragraph, (taken < 0) & active[doc])
                wrapped = line[at] != line[stop - 1]
                active[:] = False
                left: list[tuple[int, int]] = []
                # Of overlapping notices the more probable one stands.
                for x, y, k, p in sorted(predicted(at[wrapped], stop[wrapped]), key=lambda u: (-u[3], u[0])):
                    held = own.confirms(k, words[x:y])
                    if held is None:
                        left.append((x, y))
                    elif np.isin(taken[x + held[0] : x + held[1]], (-1, k)).all():
                        hits[doc[x]].append((x + held[0], x + held[1], k, p))
                        taken[x + held[0] : x + held[1]] = k
                        active[doc[x]] = True
                for x, y in sorted(left):
                    if not active[doc[x]] and not any(a < y and x < b for a, b in loose[doc[x]]):  # else it is cut anew, or counted as a line or window
                        loose[doc[x]].append((x, y))
            n_loose = np.array([sum((taken[x:y] < 0).all() for x, y in u) for u in loose], dtype=np.int64)
            best: list[tuple[float, str] | None] = [None] * n
            spans: list[list[dict]] = [[] for _ in range(n)]
            for d in range(n):
                for x, y, k, p in sorted(hits[d]):
                    new = {"start": int(begins[x] - offsets[d]), "end": int(ends[y - 1] - offsets[d]), "family": own.families[k], "p": p}
                    last = spans[d][-1] if spans[d] else None
                    if last and last["family"] == new["family"] and new["start"] < last["end"]:  # the same notice in two windows
                        last["end"], last["p"] = max(last["end"], new["end"]), max(last["p"], p)
                    else:
                        spans[d].append(new)
                    if best[d] is None or (p, best[d][1]) > (best[d][0], new["family"]):
                        best[d] = (p, new["family"])
            yield batch, [
                pa.array([b[1] if b else None for b in best], pa.string()), pa.array([b[0] if b else 0.0 for b in best], pa.float64()), pa.array([len(s) for s in spans], pa.int64()), pa.array(n_loose),
                pa.array([sorted({x["family"] for x in s}) for s in spans], pa.list_(pa.string())), pa.array(spans, span),
            ]

    return map_texts(docs, text_col, run, "family string, score double, n_confirmed long, n_unconfirmed long, families array<string>, spans array<struct<start:long,end:long,family:string,p:double>>", keep_text)
