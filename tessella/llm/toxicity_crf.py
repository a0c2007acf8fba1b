"""Toxicity by a linear-chain conditional random field over words.

Tokens of a bounded sample of labelled documents are labelled first: a word of a
toxic document is a toxic token if one of its cues (the word, its first 4, 5 or 6
bytes, its last 4) occurs in toxic sample documents far more often than in clean
ones. A two-state chain with weights for those cues, for the neighbours' words and
for the transitions is trained on sentences by gradient steps, with
forward-backward for the expectations. Every word of every document then gets its
marginal from an exact forward-backward pass over the whole text; marginals
aggregate to a document score, calibrated by logistic regression on the sample,
and to the offsets of offending spans.

Defined cases: null and empty texts have no tokens and score as documents
without toxic evidence; documents whose labels are null are not learned from,
rows of labels that repeat count once and a document labelled both ways counts as
toxic; with labels of one class only every score is 0 or that class's share;
other columns pass through (result columns win on clashing names).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import class_sample, map_texts
from ._text import LETTER_DIGIT, LOWER, U64, buffer_of, mix, span_hash, text_batches, word_spans

#: Labelled documents of each class that training may see.
SAMPLE_PER_CLASS = 600
#: Sample documents of more bytes are not trained on (they are scored like all others), so the driver holds a bounded sample.
SAMPLE_TEXT_BYTES = 1 << 16
#: Sentences with a cue, and without, that the chain is trained on; more are thinned out evenly.
SENTENCES = 10_000
#: A cue is a feature this many times as frequent in toxic sample documents, by at least this log-likelihood
#: ratio: at 25, chance makes less than one in a million features a cue.
CUE_RATIO, CUE_G = 15.0, 25.0
MAX_FEATURES = 20_000
SENTENCE = 32
BATCH_BYTES = 8 << 20
#: Own cues of a word, then those of its neighbours.
_OWN, _ALL = 5, 7


def features(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit feature hashes, a row for each kind; 0 where a word is too short or has no such neighbour."""
    n = len(begins)
    out = np.zeros((_ALL, n), dtype=U64)
    size = ends - begins
    word = span_hash(data, begins, ends)
    out[0] = mix(word ^ U64(11))
    for k, width in enumerate((4, 5, 6), 1):
        at = np.flatnonzero(size >= width)
        out[k, at] = mix(span_hash(data, begins[at], begins[at] + width) ^ U64(11 + k))
    at = np.flatnonzero(size >= 5)
    out[4, at] = mix(span_hash(data, ends[at] - 4, ends[at]) ^ U64(15))
    if n:
        out[5, 1:], out[6, :-1] = mix(word[:-1] ^ U64(16)), mix(word[1:] ^ U64(17))
        starts = first[:-1][np.diff(first) > 0]
        out[5, starts] = 0
        out[6, starts[1:] - 1] = 0
        out[6, n - 1] = 0
    return out


@dataclass
class Crf:
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    #: Log weights of the steps between the clean and the toxic state, [from, to].
    steps: np.ndarray
    calibration: np.ndarray = field(default_factory=lambda: np.array([-4.0, 1.0, 0.0]))

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> U64(44)).astype(np.int64)] = True

    def slots(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, slots of known features) in a row of hashes."""
        at = np.flatnonzero(self.maybe[(found >> U64(44)).astype(np.int64)])
        if not len(self.keys):
            return at[:0], at[:0]
        slot = np.minimum(np.searchsorted(self.keys, found[at]), len(self.keys) - 1)
        same = self.keys[slot] == found[at]
        return at[same], slot[same]

    def emissions(self, found: np.ndarray) -> np.ndarray:
        """Log odds of the toxic state at each word, by itself."""
        u = np.full(found.shape[1], self.bias)
        for row in found:
            at, slot = self.slots(row)
            u[at] += self.weights[slot]
        return u

    def marginals(self, u: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Exact forward-backward over all documents of a batch in step, longest first."""
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        order = order[n[order] > 0]
        begin, size = first[:-1][order], n[order]
        e = np.exp(np.clip(u, -50, 50))
        (a00, a01), (a10, a11) = np.exp(self.steps)
        ahead, back = np.empty(len(u)), np.empty(len(u))
        live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
        r = np.empty(0)
        for t, m in enumerate(live):
            at = begin[:m] + t
            r = e[at] if not t else e[at] * (a01 + r[:m] * a11) / (a00 + r[:m] * a10)
            r = np.clip(r, 1e-30, 1e30)
            ahead[at] = r
        end = begin + size - 1
        s = np.empty(0)
        for t, m in enumerate(live):
            at = end[:m] - t
            if not t:
                s = np.ones(m)
            else:
                x = e[at + 1] * s[:m]
                s = (a10 + a11 * x) / (a00 + a01 * x)
            back[at] = s
        odds = ahead * back
        return odds / (1 + odds)

    def document_features(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each document: 1, the logit of its largest marginal, the log of the expected toxic words."""
        n = len(first) - 1
        top, total = np.zeros(n), np.zeros(n)
        some = np.diff(first) > 0
        if some.any():
            top[some] = np.maximum.reduceat(p, first[:-1][some])
            total[some] = np.add.reduceat(p, first[:-1][some])
        top = np.clip(top, 1e-6, 1 - 1e-6)
        return np.stack([np.ones(n), np.log(top / (1 - top)), np.log1p(total)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.calibration, -40, 40)))


def _words(texts: pa.Array):
    data, offsets = buffer_of(texts)
    data = LOWER[data]
    return data, offsets, *word_spans(data, offsets, LETTER_DIGIT)


def _expectations(u: np.ndarray, steps: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state and summed step marginals of padded sentences [n, length]."""
    n, length = u.shape
    emit = np.stack([np.zeros_like(u), u], axis=2)
    a, b = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    a[:, 0] = emit[:, 0]
    for t in range(1, length):
        step = np.logaddexp(a[:, t - 1, 0, None] + steps[0], a[:, t - 1, 1, None] + steps[1]) + emit[:, t]
        a[:, t] = np.where(live[:, t, None], step, a[:, t - 1])
    for t in range(length - 2, -1, -1):
        x = emit[:, t + 1] + b[:, t + 1]
        step = np.stack([np.logaddexp(x[:, 0] + steps[0, 0], x[:, 1] + steps[0, 1]), np.logaddexp(x[:, 0] + steps[1, 0], x[:, 1] + steps[1, 1])], axis=1)
        b[:, t] = np.where(live[:, t + 1, None], step, 0)
    z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
    p = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None]) * live
    pair = a[:, :-1, :, None] + steps + (emit + b)[:, 1:, None, :] - z[:, None, None, None]
    return p, (np.exp(pair) * live[:, 1:, None, None]).sum(axis=(0, 1))


def train(texts: list[str], toxic: list[bool], rounds: int = 60) -> Crf:
    """Fit the chain and its document calibration on sample documents."""
    data, _, begins, ends, first = _words(pa.array(texts, pa.string()))
    found, n_words, y = features(data, begins, ends, first), np.diff(first), np.array(toxic, dtype=bool)
    doc = np.repeat(np.arange(len(texts)), n_words)
    n1, n0 = int(y.sum()), int((~y).sum())
    # Document frequencies by class of the own features, one kind at a time.
    cues = [np.zeros(0, dtype=U64)]
    for row in found[:_OWN] if n1 and n0 else ():
        order = np.lexsort((doc, row))
        k, d = row[order], doc[order]
        once = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]))[: len(k)] & (k != 0)
        k, d = k[once], d[once]
        first_of = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
        if not len(k):
            continue
        df1 = np.add.reduceat(y[d].astype(np.int64), first_of)
        df0 = np.diff(np.append(first_of, len(k))) - df1
        with np.errstate(divide="ignore", invalid="ignore"):
            g = 2 * (np.where(df1 > 0, df1 * np.log(df1 * len(y) / ((df1 + df0) * n1)), 0) + np.where(df0 > 0, df0 * np.log(df0 * len(y) / ((df1 + df0) * n0)), 0))
        cues.append(k[first_of[(g >= CUE_G) & ((df1 + 0.5) / (n1 + 1) > CUE_RATIO * (df0 + 0.5) / (n0 + 1))]])
    cue_keys = np.unique(np.concatenate(cues))
    cue = np.isin(found[:_OWN], cue_keys).any(axis=0) & y[doc]
    # Features: the cues, then the most frequent ones of all kinds.
    often, count = [], []
    for row in found:
        keys, n = np.unique(row[row != 0], return_counts=True)
        often.append(keys[n >= 5])
        count.append(n[n >= 5])
    often, count = np.concatenate(often), np.concatenate(count)
    often = often[np.argsort(-count, kind="stable")[:MAX_FEATURES]]
    model = Crf(np.union1d(cue_keys, often), np.zeros(0), -4.0, np.zeros((2, 2)))
    model.weights = np.zeros(len(model.keys))
    # Sentences: all pieces that hold a toxic token and as many others at fixed steps.
    rank = np.arange(len(doc)) - first[:-1][doc]
    starts = np.flatnonzero(rank % SENTENCE == 0)
    size = np.minimum(SENTENCE, first[1:][doc[starts]] - starts)
    has = np.add.reduceat(cue, starts) > 0 if len(starts) else np.zeros(0, bool)
    rest = np.flatnonzero(~has)
    some = np.flatnonzero(has)
    take = np.concatenate([x[:: max(1, -(-len(x) // SENTENCES))] for x in (some, rest)])
    starts, size = starts[take], size[take]
    if len(starts):
        places = starts[:, None] + np.arange(SENTENCE)
        live = np.arange(SENTENCE) < size[:, None]
        places = np.where(live, places, 0)
        gold = cue[places] & live
        both = gold[:, :-1, None] * 2 + gold[:, 1:, None]
        gold_steps = np.array([((both[..., 0] == c) & live[:, 1:]).sum() for c in range(4)]).reshape(2, 2)
        word_at = np.full(len(doc), -1)
        word_at[places[live]] = np.arange(int(live.sum()))
        slot, where = [], []
        for row in found:
            at, s = model.slots(row)
            keep = word_at[at] >= 0
            slot.append(s[keep])
            where.append(word_at[at][keep])
        slot, where = np.concatenate(slot), np.concatenate(where)
        n_tokens, n_keys = int(live.sum()), len(model.keys)
        moment = [np.zeros(n_keys), np.zeros(1), np.zeros((2, 2))]
        for _ in range(rounds):
            u = np.zeros(live.shape)
            u[live] = model.bias + np.bincount(where, weights=model.weights[slot], minlength=n_tokens)
            p, steps = _expectations(u, model.steps, live)
            miss = (gold - p)[live]
            grads = [np.bincount(slot, weights=miss[where], minlength=n_keys) - 0.02 * model.weights, np.array([miss.sum()]), gold_steps - steps - 0.1 * model.steps]
            for m, g in zip(moment, grads, strict=True):
                m += g * g
            change = [0.5 * g / np.sqrt(m + 1e-8) for g, m in zip(grads, moment, strict=True)]
            model.weights = model.weights + change[0]
            model.bias += float(change[1][0])
            model.steps = model.steps + change[2]
    keep = np.abs(model.weights) > 1e-3
    model = Crf(model.keys[keep], model.weights[keep], model.bias, model.steps)
    x = model.document_features(model.marginals(model.emissions(found), first), first)
    if not n1 or not n0:
        model.calibration = np.array([40.0 if n1 else -40.0, 0.0, 0.0])
        return model
    w = np.array([0.0, 0.5, 0.0])
    for _ in range(25):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.05, 0.05, 0.05])
        w = w + np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.05 * w), -2, 2)
    model.calibration = w
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, text_bytes: int = SAMPLE_TEXT_BYTES) -> Crf:
    """Train on a sample of at most about per_class labelled documents of each class, of at most text_bytes each."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = class_sample(known, "doc_id", "toxic", per_class)
    # At most about two classes of per_class ids.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").filter(F.octet_length("text") <= text_bytes).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text for r in rows], [r.toxic == 1 for r in rows])


def spans_of(p: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, largest marginal) of runs of words of marginal 0.5 and more."""
    hit = p >= 0.5
    on = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
    off = np.flatnonzero(hit & ~np.append(hit[1:], False))
    return begins[on], ends[off], np.array([p[a : b + 1].max() for a, b in zip(on, off, strict=True)])


def score_documents(docs: DataFrame, model: Crf, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Each row with score, predicted and spans (byte offsets of toxic spans with their marginals)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        for batch in text_batches(batches, text_col, BATCH_BYTES):
            data, offsets, begins, ends, first = _words(batch.column(text_col))
            p = own.marginals(own.emissions(features(data, begins, ends, first)), first)
            score = own.score(own.document_features(p, first))
            spans = [[] for _ in range(batch.num_rows)]
            for d in np.unique(np.searchsorted(first, np.flatnonzero(p >= 0.5), side="right") - 1):
                a, b = first[d], first[d + 1]
                spans[d] = [{"start": int(x - offsets[d]), "end": int(y - offsets[d]), "p": float(z)} for x, y, z in zip(*spans_of(p[a:b], begins[a:b], ends[a:b]), strict=True)]
            yield batch, [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, kind)]

    return map_texts(docs, text_col, run, "score double, predicted int, spans array<struct<start:long,end:long,p:double>>", keep_text)
