"""LM scoring by the likelihood of subword lattices.

The pieces of an existing vocabulary span a lattice over each word (a space and the
word's bytes; single bytes always fit). Log-probabilities of the pieces weight
all segmentations, and a forward recursion in log space gives a word's marginal
probability. The weights start from the vocabulary file's own scores (where these are ranks of merges,
their order is taken as a Zipf rank) and are re-estimated on all training words by
expectation-maximisation, with forward-backward over the same lattices.

A word of the training rows has one more segmentation, the word as a whole, with its discounted
count: (count - D) / N with D = n1 / (n1 + 2 n2) from the numbers of words seen once and twice. What the discount
takes, D * V / N, is the weight of going through the pieces, so each of the V words counts D times
in their estimation. P(word) = max(count - D, 0) / N + D * V / N * marginal: a frequent word lives by its count, a rare one mostly and an unknown
one wholly by the lattice. A document's probability is the product over its words and one end token. Weights of all
words and pieces sum to one over all documents.

Words are counted by block: a task reduces a block of documents to its distinct words, so a
frequent word is one row a block and not one row a document, and the counts come
back to the block the same way. The blocks' codes are written once and only read after that, so a repeated task cannot
number them otherwise. Nothing of the size of the vocabulary is broadcast or collected.

Defined cases: null and empty texts hold the end token alone; without training
documents N and V are 0 and every word has the lattice's probability alone; words of any length are scored
whole; repeated rows count as often as they stand; doc_id may be null (never held out); other
columns are ignored. Pieces with A-Z or with a space behind their first byte are not in the lattice: no lower-cased word
holds them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut_lineage, map_batches, release
from ._text import _KEEP, LOWER, NOT_SPACE, U64, buffer_of, loads, mix, span_hash, text_batches, word_spans

BLOCK_BYTES = 16 << 20
ROUNDS = 2
_LN10 = math.log(10)
_MULT = U64(0x9E3779B97F4A7C15)
_NEG = -1e30


@cache
def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The usable pieces of a sentencepiece file, lower case, behind the 256 single bytes; and their first log-probabilities."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    seen: dict[bytes, float] = {bytes([b]): -40_000.0 for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece and piece.rfind(b" ") <= 0 and not any(65 <= b <= 90 for b in piece):
            seen[piece] = max(seen.get(piece, -1e9), model.get_score(i))
    pieces = list(seen)
    rank = -np.array([seen[p] for p in pieces])
    p = 1 / (rank - rank.min() + 20)
    return pieces, np.log(p / p.sum())


def _keys(load: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for the `size` bytes at each place: the bytes themselves up to eight, a hash beyond."""
    key = load[at] & _KEEP[min(size, 8)]
    for k in range(8, size, 8):
        key = mix(key * _MULT + (load[at + k] & _KEEP[min(size - k, 8)]))
    return key


class Lattice:
    """All segmentations of many words into weighted pieces."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.logp = logp
        self.tables = {}
        self.longest = max(map(len, pieces))
        for size in range(2, self.longest + 1):
            own = [i for i, p in enumerate(pieces) if len(p) == size]
            if own:
                load = loads(np.frombuffer(b"".join(pieces[i] for i in own) + b"\0" * (size + 16), dtype=np.uint8))
                keys = _keys(load, np.arange(len(own)) * size, size)
                order = np.argsort(keys)
                maybe = np.zeros(1 << 18, dtype=bool)
                maybe[(keys * _MULT >> U64(46)).astype(np.int64)] = True
                self.tables[size] = keys[order], np.array(own)[order], maybe

    def _ids(self, text: np.ndarray, n: int, length: int) -> np.ndarray:
        """Piece ids [size, word, start] of n words of one length laid end to end; -1 where no piece fits."""
        top = min(self.longest, length)
        ids = np.full((top + 1, n, length), -1, dtype=np.int32)
        ids[1] = text[: n * length].reshape(n, length)
        load = loads(text)
        for size in range(2, top + 1):
            if size not in self.tables:
                continue
            keys, own, maybe = self.tables[size]
            at = (np.arange(n)[:, None] * length + np.arange(length - size + 1)).ravel()
            k = _keys(load, at, size)
            some = np.flatnonzero(maybe[(k * _MULT >> U64(46)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(keys, k[some]), len(keys) - 1)
            same = keys[slot] == k[some]
            ids[size].reshape(-1)[at[some[same]]] = own[slot[same]]
        return ids

    @staticmethod
    def _sum(parts: np.ndarray) -> np.ndarray:
        top = parts.max(axis=0)
        return top + np.log(np.exp(parts - top).sum(axis=0))

    def run(self, words: list[bytes], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """(log marginal of each word, expected piece counts if weights are given)."""
        out = np.zeros(len(words))
        counts = None if weights is None else np.zeros(len(self.logp))
        size = np.array([len(w) + 1 for w in words])
        for length in np.unique(size).tolist():
            every = np.flatnonzero(size == length)
            step = max(1, (1 << 17) // length)
            for c in range(0, len(every), step):
                rows = every[c : c + step]
                n = len(rows)
                text = np.frombuffer(b"".join(b" " + words[i] for i in rows) + b"\0" * (self.longest + 16), dtype=np.uint8)
                ids = self._ids(text, n, length)
                used = [k for k in range(1, ids.shape[0]) if k == 1 or (ids[k] >= 0).any()]
                lp = np.where(ids >= 0, self.logp[ids], _NEG)
                ahead = np.zeros((length + 1, n))
                for t in range(1, length + 1):
                    sizes = [k for k in used if k <= t]
                    ahead[t] = self._sum(np.stack([ahead[t - s] + lp[s, :, t - s] for s in sizes]))
                out[rows] = ahead[length]
                if counts is not None:
                    back = np.zeros((length + 1, n))
                    for t in range(length - 1, -1, -1):
                        sizes = [k for k in used if k <= length - t]
                        back[t] = self._sum(np.stack([back[t + s] + lp[s, :, t] for s in sizes]))
                    base = weights[rows] - 0.0
                    for s in used:
                        w = np.exp(ahead[: length - s + 1].T + lp[s, :, : length - s + 1] + back[s:].T - ahead[length][:, None]) * base[:, None]
                        own = ids[s, :, : length - s + 1]
                        good = own >= 0
                        counts += np.bincount(own[good], weights=w[good], minlength=len(self.logp))
        return out, counts


@dataclass
class LatticeModel:
    path: str
    logp: np.ndarray
    total: int
    distinct: int
    ends: int
    discount: float

    def word_log10(self, lattice: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P of words with these log marginals and training counts."""
        if not self.total:
            return lattice / _LN10
        words = self.distinct - (self.ends > 0)
        through = math.log(self.discount * words) if words else 0.0
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(count - self.discount, 0.0))
        return (np.logaddexp(whole, through + lattice) - math.log(self.total)) / _LN10


_KEPT: dict[int, Lattice] = {}


def _lattice(path: str, logp: np.ndarray) -> Lattice:
    """The worker's lattice of these weights; one is kept."""
    key = hash(logp.tobytes())
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Lattice(vocabulary(path)[0], logp)
    return _KEPT[key]


def _blocks(docs: DataFrame, kernel, ddl: str) -> DataFrame:
    """Run a kernel on blocks of whole documents: (block number, batch, lowered bytes, words of each document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 20
        held: list[pa.RecordBatch] = []
        size = 0

        def work():
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            data, offsets = buffer_of(batch.column("text"))
            data = LOWER[data]
            return kernel(block, batch, data, *word_spans(data, offsets, NOT_SPACE))

        for batch in text_batches(batches, "text", BLOCK_BYTES):
            if held and size + batch.nbytes > BLOCK_BYTES:
                yield from work()
                held, size, block = [], 0, block + 1
            held.append(batch)
            size += batch.nbytes
        if held:
            yield from work()

    return map_batches(docs, run, ddl)


def _distinct(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, a place of each, the number of each word) of the distinct words."""
    return np.unique(span_hash(data, begins, ends), return_index=True, return_inverse=True)


def count_words(docs: DataFrame) -> DataFrame:
    """word (bytes), h (hash), c: training count (0 for words of held-out documents only)."""

    def kernel(block, batch, data, begins, ends, first):
        h, at, which = _distinct(data, begins, ends)
        train = np.repeat(~np.asarray(batch.column("held_out").to_pylist(), dtype=bool), np.diff(first))
        c = np.bincount(which, weights=train, minlength=len(h)).astype(np.int64)
        raw = data.tobytes()
        for k in range(0, len(h), 50_000):
            part = at[k : k + 50_000]
            words = [raw[a:b] for a, b in zip(begins[part].tolist(), ends[part].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(h[k : k + 50_000].view(np.int64)), pa.array(c[k : k + 50_000])], names=["word", "h", "c"])

    return _blocks(docs, kernel, "word binary, h long, c long").groupBy("word", "h").agg(F.sum("c").alias("c"))


def fit(words: DataFrame, ends: int, path: str, rounds: int = ROUNDS) -> LatticeModel:
    """Estimate piece weights and discount from the word table (word, c) and the number of training documents."""
    trained = words.filter("c > 0")
    r = trained.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")).head()
    pieces, logp = vocabulary(path)
    model = LatticeModel(path, logp, r.n + ends, r.v + (ends > 0), ends, r.once / (r.once + 2 * r.twice) if r.once else 0.5)
    if not r.n:
        return model

    def expect(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
        own, total = _lattice(path, weights), np.zeros(len(weights))
        for batch in batches:
            total += own.run(batch.column("word").to_pylist(), np.ones(batch.num_rows))[1]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "e"])

    for _ in range(rounds):
        weights = model.logp
        e = np.full(len(pieces), 0.01)
        for row in map_batches(trained.select("word"), lambda b, w=weights: expect(b, w), "piece long, e double").groupBy("piece").agg(F.sum("e").alias("e")).collect():  # one row a piece
            e[row.piece] += row.e
        model.logp = np.log(e / e.sum())
    return model


def score_documents(docs: DataFrame, held_out: Column, path: str, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and score_per_token of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words = cut_lineage(count_words(docs))
    model = fit(words, docs.filter(~F.col("held_out")).count(), path, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        own = _lattice(m.path, m.logp)
        for batch in batches:
            lp = m.word_log10(own.run(batch.column("word").to_pylist())[0], np.asarray(batch.column("c")))
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), pa.array(lp)], names=["h", "c", "lp"])

    valued = map_batches(words.select("word", "h", "c"), marginals, "h long, c long, lp double")

    def codes(block, batch, data, begins, ends, first):
        """The documents of a block as places in its list of words, packed; the list (its hashes) stands with the first of them."""
        h, _, which = _distinct(data, begins, ends)
        which, codec = which.astype("<i4").ravel(), pa.Codec("zstd", compression_level=1)
        for k in range(0, batch.num_rows, 2000):
            part = batch.slice(k, 2000)
            at = first[k : k + part.num_rows + 1]
            ids = [codec.compress(which[a:b], asbytes=True) for a, b in zip(at[:-1], at[1:], strict=True)]
            own = [h.tobytes() if not k + i else None for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block)), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(at).astype(np.int64)), pa.array(ids, pa.binary()), pa.array(own, pa.binary())], names=["block", "doc_id", "held_out", "n", "ids", "words"])

    coded = cut_lineage(_blocks(docs, codes, f"block long, doc_id {kind}, held_out boolean, n long, ids binary, words binary"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
                h = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), block)), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(h)], names=["block", "local", "h"])

    back = map_batches(coded.filter("words is not null").select("block", "words"), listed, "block long, local int, h long").join(valued, "h").select("block", "local", "c", "lp")

    def add_up(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        c, lp = np.zeros(len(right), dtype=np.int64), np.zeros(len(right))
        c[right["local"]], lp[right["local"]] = right["c"], right["lp"]
        base = np.log10((c + 0.1) / (m.total + 0.1 * (m.distinct + 1)))
        end = math.log10((m.ends + 0.1) / (m.total + 0.1 * (m.distinct + 1)))
        model_end = math.log10(m.ends / m.total) if m.ends else 0.0
        codec, sums = pa.Codec("zstd"), []
        for n, packed in zip(left["n"], left["ids"], strict=True):  # one document at a time is unpacked
            x = np.frombuffer(codec.decompress(packed, decompressed_size=4 * int(n)), "<i4") if n else np.zeros(0, np.int32)
            sums.append((len(x) + 1, int((c[x] > 0).sum()) + (m.ends > 0), float(base[x].sum()) + end, float(lp[x].sum()) + model_end))
        out = pd.DataFrame(sums, columns=["n_tokens", "n_known", "base_score", "score"])
        out = out.assign(doc_id=left["doc_id"].to_numpy(), held_out=left["held_out"].to_numpy(), train_tokens=m.total, score_per_token=out["score"] / out["n_tokens"])
        release()
        return out

    ddl = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, score_per_token double"
    return coded.drop("words").groupBy("block").cogroup(back.groupBy("block")).applyInPandas(add_up, ddl)
