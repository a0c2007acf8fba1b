"""Language identification by nearest centroids of hashed n-gram vectors.

A text's vector holds the byte 2- and 3-grams around its letters, hashed into
`dims` slots and weighted (1 + ln tf) * idf, with length one. Document
frequencies, centroids and limits come from all training rows. Each language has
several centroids: spherical k-means in passes over the packed counts of all its
rows, started from equal shares of them by the cosine with their mean. A text takes
the language of the centroid of largest cosine; it is
rejected if that cosine is below the distance limit of this language for texts of
about as many n-grams. Limits are MARGIN times the QUANTILE of held-out cosines (counted in
COSINE_BINS steps): each training text, whole and cut to CUTS bytes, against centroids of its
language that were learned without its fold. A text of a few letters has so low a limit that hardly anything rejects it.

Defined cases: null texts and texts without a letter give `und`, score 0 and
rejected; rows of null language are not learned from; without any training row
every text gives `und`; equal cosines go to the language first by name; repeated
rows count as often as they stand; a language of one training text has no limit;
other columns pass through (result columns
win on clashing names).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut_lineage, map_batches, map_texts, schema
from ._text import LOWER, U64, buffer_of, loads, text_batches

DIMS = 1 << 12
#: Centroids of a language, and rounds of k-means at most; it ends when no place of a centroid moves further than SETTLED.
CENTROIDS, ROUNDS, SETTLED = 4, 6, 1e-4
#: Steps in which cosines with a mean and held-out cosines are counted.
SHARE_BINS, COSINE_BINS = 2048, 20_000
#: A text is rejected below MARGIN times this quantile of the held-out cosines of its language and length.
QUANTILE, MARGIN = 0.005, 0.9
#: Parts of the training rows that are held out in turn, and the lengths in bytes to which held-out texts are cut.
FOLDS, CUTS = 4, (8, 16, 32, 64, 128, 256, 512, 1024, 2048)
#: Bands of n-grams a text, each with limits of its own.
EDGES = 8 << np.arange(10)
BATCH_BYTES, BATCH_ROWS = 1 << 20, 256
_ASCII_LETTER = re.compile("[A-Za-z]")
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[97:123] = _LETTERS[128:] = True
_MULT = U64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    """Whether a character of Unicode's letter categories stands in a text (number signs are none)."""
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _grams(column: pa.Array, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of a batch of texts, width by width: row * dims + slot, and where in its text each ends."""
    data, offsets = buffer_of(column)
    total = int(offsets[-1])
    if not total:
        return
    text = LOWER[data]
    letter = _LETTERS[text]
    text[~letter] = 0x20
    load = loads(text)[:total]
    size = np.diff(offsets)
    rows = np.repeat(np.arange(len(size), dtype=np.int64) * dims, size)
    place = np.arange(total) - np.repeat(offsets[:-1], size)
    left = np.repeat(size, size) - place
    shift = U64(64 - dims.bit_length() + 1)
    for width in (2, 3):
        here = letter[:total] | letter[1 : total + 1]
        here &= left >= width
        slot = ((load & U64((1 << 8 * width) - 1)) * _MULT + U64(width << 40)) * _MULT >> shift
        yield (rows + slot.astype(np.int64))[here], place[here] + width


def counts(column: pa.Array, dims: int = DIMS) -> np.ndarray:
    """n-gram counts of a batch of texts, one row each."""
    out = np.zeros(len(column) * dims, dtype=np.int64)
    for slots, _ in _grams(column, dims):
        out += np.bincount(slots, minlength=len(out))
    return out.reshape(len(column), dims).astype(np.float32)


def weigh(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised (1 + ln tf) * idf; a row without n-grams stays zero."""
    with np.errstate(divide="ignore"):
        return _unit(np.where(tf > 0, 1 + np.log(tf), 0).astype(np.float32) * idf)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def pack(tf: np.ndarray) -> list[pa.Array]:
    """Counts, one row a text, as three binary columns: which slots are in use, their counts up to 255, and in full those from 255 on."""
    some = tf > 0
    used = tf[some].astype(np.uint32)
    bits = np.packbits(some, axis=1)
    return [_binary(bits, bits.shape[1] * np.arange(1, len(tf) + 1)), _binary(np.minimum(used, 255).astype(np.uint8), np.cumsum(some.sum(axis=1))), _binary(used[used >= 255].astype("<u4"), 4 * np.cumsum((tf >= 255).sum(axis=1)))]


def unpack(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which slots are in use (boolean, one row a text), and the counts of those in use, row after row."""
    (bits, _), (low, ends), (over, more) = (buffer_of(batch.column(c)) for c in ("bits", "low", "over"))
    some = np.unpackbits(bits[: batch.num_rows * dims // 8].reshape(batch.num_rows, dims // 8), axis=1).view(bool)
    used = low[: int(ends[-1])].astype(np.float32)
    used[used == 255] = np.frombuffer(over[: int(more[-1])].tobytes(), "<u4")
    return some, used


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.divide(v, size, out=np.zeros_like(v), where=size > 0)


def _by_language(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(language, vectors, for each model whether it learns from the row): model k learns from all folds but k, the last from all."""
    for batch in text_batches(batches, "low", BATCH_BYTES, BATCH_ROWS):
        some, used = unpack(batch, len(idf))
        x = np.zeros(some.shape, dtype=np.float32)
        x[some] = 1 + np.log(used)
        x = _unit(x * idf)
        learns = np.asarray(batch.column("fold"))[:, None] != np.arange(FOLDS + 1)
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            at = np.flatnonzero((langs == lang) & some.any(axis=1))
            if len(at):
                yield lang, x[at], learns[at]


def _means(packed: DataFrame, idf: np.ndarray, k: int, choose: Callable[[str, np.ndarray], np.ndarray]) -> dict[str, np.ndarray]:
    """By language, for each model the unit means of the k groups that `choose` deals vectors to; zero where a group is empty."""
    dims, models = len(idf), FOLDS + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for lang, x, learns in _by_language(batches, idf):
            own = (choose(lang, x)[:, :, None] == np.arange(k)) & learns[:, :, None]
            total.setdefault(lang, np.zeros((models * k, dims)))[:] += own.reshape(len(x), models * k).T.astype(np.float32) @ x
        for lang, v in total.items():
            at = np.flatnonzero(v.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array([v[j].astype(np.float32).tobytes() for j in at], pa.binary())], names=["lang", "j", "v"])

    def added(rows: pa.Table) -> pa.Table:
        v = np.zeros(dims)
        for x in rows.column("v").to_pylist():
            v += np.frombuffer(x, np.float32)
        return rows.slice(0, 1).select(["lang", "j"]).append_column("v", pa.array([v.astype(np.float32).tobytes()], pa.binary()))

    ddl = "lang string, j int, v binary"
    out: dict[str, np.ndarray] = {}
    for r in map_batches(packed, sums, ddl).groupBy("lang", "j").applyInArrow(added, schema(ddl)).collect():  # one row a centroid
        out.setdefault(r.lang, np.zeros((models * k, dims), dtype=np.float32))[r.j] = np.frombuffer(r.v, np.float32)
    return {lang: _unit(v).reshape(models, k, dims) for lang, v in out.items()}


def _shares(packed: DataFrame, idf: np.ndarray, means: Broadcast, k: int) -> dict[str, np.ndarray]:
    """By language, for each model and step of the cosine with its mean the share it falls into, of k that hold about as many rows each."""
    models = FOLDS + 1

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for lang, x, learns in _by_language(batches, idf):
            at = _step(x @ means.value[lang][:, 0].T) + np.arange(models) * SHARE_BINS
            total.setdefault(lang, np.zeros(models * SHARE_BINS, dtype=np.int64))[:] += np.bincount(at[learns], minlength=models * SHARE_BINS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "at", "n"])

    found = map_batches(packed, steps, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()  # at most SHARE_BINS rows a model
    out = {}
    for lang, rows in found.groupby("lang"):
        n = np.zeros(models * SHARE_BINS)
        n[rows["at"]] = rows["n"]
        n = n.reshape(models, SHARE_BINS)
        middle = (np.cumsum(n, axis=1) - n / 2) / np.maximum(n.sum(axis=1, keepdims=True), 1)
        out[lang] = np.minimum((k * middle).astype(np.int64), k - 1)
    return out


def _step(cosine: np.ndarray) -> np.ndarray:
    return np.clip(cosine * SHARE_BINS, 0, SHARE_BINS - 1).astype(np.int64)


def centroids_of(packed: DataFrame, idf: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """By language, centroids of FOLDS models that leave out a fold each and of one of all rows (models x k x dims): spherical k-means over all rows."""
    sc = packed.sparkSession.sparkContext
    first = sc.broadcast(_means(packed, idf, 1, lambda _, x: np.zeros((len(x), FOLDS + 1), dtype=np.int64)))
    if not first.value:
        return {}
    share = sc.broadcast(_shares(packed, idf, first, k))
    centres = _means(packed, idf, k, lambda lang, x: share.value[lang][np.arange(FOLDS + 1), _step(x @ first.value[lang][:, 0].T)])
    for _ in range(ROUNDS):
        now = sc.broadcast(centres)

        def nearest(lang: str, x: np.ndarray, now: Broadcast = now) -> np.ndarray:
            c = now.value[lang]
            return (x @ c.reshape(-1, c.shape[2]).T).reshape(len(x), *c.shape[:2]).argmax(axis=2)

        found = _means(packed, idf, k, nearest)
        # A centroid that nothing is nearest to stays where it is.
        found = {lang: np.where(c.any(axis=2, keepdims=True), c, centres[lang]) for lang, c in found.items()}
        moved = max(float(np.abs(found[lang] - c).max()) for lang, c in centres.items())
        centres = found
        now.unpersist()
        if moved < SETTLED:
            break
    return centres


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    limits: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(languages, scores from 0 to 1, rejected) of a batch."""
        some = np.fromiter(map(has_letter, texts.to_pylist()), dtype=bool, count=len(texts))
        if not self.languages:
            return ["und"] * len(some), np.zeros(len(some)), np.ones(len(some), dtype=bool)
        tf = counts(texts, len(self.idf))
        band = np.searchsorted(EDGES, tf.sum(axis=1), side="right")
        cosine = weigh(tf, self.idf) @ self.centroids.T
        best = np.argmax(cosine, axis=1)
        score = np.clip(cosine[np.arange(len(some)), best].astype(np.float64), 0, 1) * some
        return [self.languages[self.of[b]] if ok else "und" for b, ok in zip(best, some, strict=True)], score, ~some | (score < self.limits[self.of[best], band])


def _limits(train: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The limit of each band by language, from the held-out cosines of all rows; an empty band takes the one of shorter texts."""
    dims = len(idf)
    shared = train.sparkSession.sparkContext.broadcast({lang: c[:FOLDS] for lang, c in centres.items()})

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in text_batches(batches, "text", BATCH_BYTES, BATCH_ROWS):
            n, long = batch.num_rows, np.asarray(pc.binary_length(batch.column("text").cast(pa.large_binary())))
            fold, langs = np.asarray(batch.column("fold")), np.array(batch.column("lang").to_pylist(), dtype=object)
            groups = [(lang, f, (langs == lang) & (fold == f)) for lang in set(langs) & shared.value.keys() for f in range(FOLDS) if shared.value[lang][f].any()]
            grams = list(_grams(batch.column("text"), dims))
            part = [np.searchsorted(CUTS, end) for _, end in grams]
            tf = np.zeros(n * dims, dtype=np.int32)
            for k, cut in enumerate((*CUTS, None)):
                # The n-grams that end within this cut, but in no shorter one.
                for (slots, _), own in zip(grams, part, strict=True):
                    if len(new := slots[own == k]):
                        tf += np.bincount(new, minlength=n * dims).astype(np.int32)
                whole = tf.reshape(n, dims)
                for lang, f, mine in groups:
                    at = np.flatnonzero(mine if cut is None else mine & (long > cut))
                    own = whole[at]
                    size = own.sum(axis=1)
                    own, size = own[size > 0], size[size > 0]
                    if len(own):
                        cosine = (weigh(own.astype(np.float32), idf) @ shared.value[lang][f].T).max(axis=1)
                        at = np.searchsorted(EDGES, size, side="right") * COSINE_BINS + np.clip(cosine * COSINE_BINS, 0, COSINE_BINS - 1).astype(np.int64)
                        np.add.at(total.setdefault(lang, np.zeros((len(EDGES) + 1) * COSINE_BINS, dtype=np.int64)), at, 1)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array((at // COSINE_BINS).astype(np.int32)), pa.array((at % COSINE_BINS).astype(np.int32)), pa.array(n[at])], names=["lang", "band", "bin", "n"])

    bins = map_batches(train, held_out, "lang string, band int, bin int, n long").groupBy("lang", "band", "bin").agg(F.sum("n").alias("n"))
    found = {(r.lang, r.band): r.q for r in bins.groupBy("lang", "band").agg(F.percentile("bin", F.lit(QUANTILE), F.col("n")).alias("q")).collect()}  # one row a language and band
    out = {}
    for lang in centres:
        own = out[lang] = np.zeros(len(EDGES) + 1)
        for k in range(len(own)):
            own[k] = MARGIN * (found[lang, k] + 0.5) / COSINE_BINS if (lang, k) in found else own[max(0, k - 1)]
    return out


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", dims: int = DIMS, centroids: int = CENTROIDS) -> LanguageModel:
    """Learn from the text and language columns of the training rows."""
    train = train.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    train = train.select("text", "lang", F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(FOLDS)).cast("int").alias("fold"))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES, BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("fold"), *pack(counts(batch.column("text"), dims))], names=["lang", "fold", "bits", "low", "over"])

    # Counts are made once; the passes read them in a few tasks, as each task's sums go through a shuffle.
    packed = cut_lineage(map_batches(train, packs, "lang string, fold int, bits binary, low binary, over binary"))
    packed = packed.coalesce(2 * max(2, train.sparkSession.sparkContext.defaultParallelism))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dims, dtype=np.int64), 0
        for batch in text_batches(batches, "low", BATCH_BYTES, BATCH_ROWS):
            df += unpack(batch, dims)[0].sum(axis=0)
            n += batch.num_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["slot", "n"])

    total = np.zeros(dims, dtype=np.float64)
    rows = 0
    for r in map_batches(packed, frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # one row a slot
        if r.slot < 0:
            rows = r.n
        else:
            total[r.slot] = r.n
    idf = np.log((1 + rows) / (1 + total)).astype(np.float32) + 1
    centres = centroids_of(packed, idf, centroids)
    if not centres:
        return LanguageModel([], idf, np.zeros((1, dims), np.float32), np.array([]), np.array([]))
    limits = _limits(train, idf, centres)
    languages = sorted(centres)
    own = [c[c.any(axis=1)] for c in (centres[lang][FOLDS] for lang in languages)]
    return LanguageModel(languages, idf, np.concatenate(own), np.repeat(np.arange(len(own)), [len(c) for c in own]), np.array([limits[lang] for lang in languages]))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Each row with lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        for batch in text_batches(batches, text_col, BATCH_BYTES, BATCH_ROWS):
            langs, score, rejected = own.predict(batch.column(text_col))
            yield batch, [pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)]

    return map_texts(docs, text_col, run, "lang_pred string, score double, rejected boolean", keep_text)
