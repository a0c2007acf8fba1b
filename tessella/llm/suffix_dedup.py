"""Exact removal of repeated byte strings by two-stage suffix sorting.

A window is a string of `length` bytes inside one document. Every byte covered by
a window that also starts anywhere else is removed.

1. Where to look. Each window chooses an anchor, the 32-byte gram of least hash in
   it, so equal windows choose equal anchors at equal offsets. A run of consecutive
   windows with one anchor is a segment: the bytes that these windows cover. Equal
   segments of one anchor are counted before anything is sent on; a segment that
   stands twice is all repeated, an anchor seen once repeats nothing.
2. Suffix sorting. Where an anchor has several different segments, each is taken
   once, and whole anchor groups are laid one behind another in blocks. Of a
   block's suffixes only those smaller than their successors are sorted directly;
   all others are induced from them by one scan over the first-byte buckets. Common
   prefixes of neighbours in the order, as far as `length`, then tell which window
   starts repeat.
3. An anchor with more than `most` different segments (a passage shared by a great
   part of the documents, whose edges differ) does not go to one task: its windows
   are told apart by the bytes that 64, then 16, 4 neighbouring windows share, and
   at last by their own bytes, in counts that are combined before each shuffle.
   This gives the same windows as sorting would.

Hashes have 64 bits and are compared only within one anchor, that is 128 bits.

Defined cases: null and empty texts have no bytes and lose none; texts shorter
than `length` are kept; cutting may split a character, so the kept bytes need not
be UTF-8 (the text form leaves out the rest of a split character); rows are told apart by doc_id, and by doc_id and
text where the doc_id is null or repeated, so such rows are separate texts like any others; columns of docs with the
name of a result or of `node` are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import FEW, cut_lineage, map_batches, release, with_nodes
from ._text import U64, buffer_of, loads, mix, text_batches

GRAM = 32
#: Windows of a block, from step to step, where segments are split.
CORES = (64, 16, 4, 1)
#: Bytes that are looked through at once: about 100 bytes of working memory stand for each.
BATCH_BYTES = 1 << 19
BLOCK_BYTES = 1 << 18
#: Segments of one anchor that a task may sort together.
MOST = 1024
_SEP = 0xFF  # never a byte of UTF-8
_A, _B = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------- suffix sorting


def _sort_directly(text: np.ndarray, raw: bytes, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in the order of their first `depth` bytes; ties in order of place."""
    load = loads(text)
    big = load[at].byteswap()
    order = np.argsort(big, kind="stable")
    at, big = at[order], big[order]
    same = big[1:] == big[:-1]
    if same.any():
        edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        out = at.tolist()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            out[a : b + 1] = sorted(out[a : b + 1], key=lambda i: raw[i + 8 : i + depth])
        at = np.array(out, dtype=np.int64)
    return at


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Starts of all suffixes of a text, in the order of at least their first `depth` bytes.

    Two stages: suffixes smaller than their successor are sorted directly; every other suffix follows
    from its successor's place while the buckets are scanned from the least first byte up.
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    t = np.frombuffer(text + b"\0" * (depth + 16), dtype=np.uint8)
    here = t[:n].astype(np.int16)
    nxt = np.append(here[1:], -1)  # the end is smaller than any byte
    # Smaller than the successor: a smaller byte, or an equal one in a run that ends so.
    rises = np.where(here < nxt, 1, np.where(here > nxt, 0, -1))
    known = np.where(rises >= 0, np.arange(n), n)
    known = np.minimum.accumulate(known[::-1])[::-1]
    small = rises[known] == 1
    starts = np.flatnonzero(small)
    direct = _sort_directly(t, text + b"\0" * (depth + 16), starts, depth)
    direct_of = here[direct]
    bound = np.searchsorted(direct_of, np.arange(257))
    # For each first byte, what the scan has induced so far.
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not small[n - 1]:
        waiting[here[n - 1]].append(np.array([n - 1]))
    out = []

    def induce(order: np.ndarray, byte: int) -> np.ndarray:
        """Deal the larger predecessors to their buckets; those of this bucket are returned."""
        before = order[order > 0] - 1
        before = before[~small[before]]
        firsts = here[before]
        mine = before[firsts == byte]
        before, firsts = before[firsts > byte], firsts[firsts > byte]
        if len(before):
            by = np.argsort(firsts, kind="stable")
            before, firsts = before[by], firsts[by]
            cut = np.flatnonzero(np.diff(firsts)) + 1
            for part in np.split(before, cut):
                waiting[here[part[0]]].append(part)
        return mine

    for byte in range(256):
        layers = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, dtype=np.int64)
        while len(layers):
            out.append(layers)
            layers = induce(layers, byte)
        own = direct[bound[byte] : bound[byte + 1]]
        if len(own):
            out.append(own)
            induce(own, byte)
    return np.concatenate(out)


def repeated_starts(text: bytes, length: int) -> np.ndarray:
    """Whether the `length` bytes at each place of a text also stand at another place (windows over 0xFF never)."""
    n = len(text)
    flag = np.zeros(n, dtype=bool)
    if n <= length:
        return flag
    order = suffix_array(text, length)
    t = np.frombuffer(text + b"\0" * 16, dtype=np.uint8)
    order = order[order <= n - length]
    load = loads(t)
    pair = np.arange(len(order) - 1)
    for at in range(0, length - 7, 8):
        pair = pair[load[order[pair] + at] == load[order[pair + 1] + at]]
    if rest := length % 8:
        mask = U64((1 << 8 * rest) - 1)
        at = length - rest
        pair = pair[(load[order[pair] + at] & mask) == (load[order[pair + 1] + at] & mask)]
    flag[order[pair]] = flag[order[pair + 1]] = True
    ends = np.concatenate([[0], np.cumsum(t[:n] == _SEP)])
    flag[: n - length + 1] &= ends[length:] == ends[: n - length + 1]
    return flag


# ---------------------------------------------------------------- anchors


def _grams(data: np.ndarray, total: int) -> np.ndarray:
    """Hashes of the 32-byte grams at each place."""
    load = loads(np.append(data, np.zeros(GRAM + 8, np.uint8)))
    h = load[: total + GRAM].copy()
    h *= _A
    h ^= h >> U64(29)
    h = h[:-8] * _B + (h[8:] ^ (h[8:] >> U64(31)))
    h ^= h >> U64(32)
    h = h[:-16] * _A + (h[16:] ^ (h[16:] >> U64(31)))
    return mix(h)[:total]


class _Sums:
    """Hashes of any span, from prefix sums of mixed 8-byte loads times powers."""

    _powers = np.zeros(0, dtype=U64)

    def __init__(self, data: np.ndarray, total: int):
        if len(_Sums._powers) < total + 2:
            _Sums._powers = np.multiply.accumulate(np.append(U64(1), np.full(max(total + 1, BATCH_BYTES * 2), _B)))
        load = loads(np.append(data, np.zeros(8, np.uint8)))[:total]
        self.sums = np.append(U64(0), np.cumsum(mix(load.copy()) * _Sums._powers[:total]))
        self.top = total

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the bytes a..b; b - a is at least 8."""
        last = b - 7
        h = (self.sums[last] - self.sums[a]) * _Sums._powers[self.top - a]
        # Scale by a power that does not depend on the batch.
        return mix(h * _inverse_power(self.top) + (b - a).astype(U64))


def _inverse_power(n: int) -> U64:
    return U64(pow(pow(int(_B), -1, 1 << 64), n, 1 << 64))


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, anchor, first window, last window, anchor hash) of every run of windows with one anchor."""
    total = int(offsets[-1])
    span = length - GRAM + 1  # grams of a window
    none = np.zeros(0, dtype=np.int64)
    if total < length:
        return none, none, none, none, none.astype(U64)
    grams = _grams(data, total)
    key = (grams >> U64(24) << U64(24)) | np.arange(total, dtype=U64)
    padded = np.append(key, np.full(-total % span + span, np.iinfo(np.uint64).max, dtype=U64)).reshape(-1, span)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:total], left[span - 1 : span - 1 + total]) & U64((1 << 24) - 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(np.arange(total) + length <= offsets[1:][doc])
    if not len(start):
        return none, none, none, none, none.astype(U64)
    anchor, of = least[start].astype(np.int64), doc[start]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return of[first], anchor[first], start[first], start[last], grams[anchor[first]]


def _stretches(data: np.ndarray, total: int, step: int, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, bytes, offsets) of parts of one text that hold `step` windows each."""
    for a in range(0, total, step):
        part = np.append(data[a : min(total, a + step + length - 1)], np.zeros(16, np.uint8))
        yield a, part, np.array([0, len(part) - 16])


def _scan(docs: DataFrame, length: int) -> DataFrame:
    """anchor, seg (hashes), node, at (first window), n (windows), back (anchor - first window) of every segment of docs (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            data, offsets = buffer_of(batch.column("text"))
            total, step = int(offsets[-1]), max(BATCH_BYTES, length)
            # A batch beyond the size is one long text: its windows are taken a stretch at a time.
            long = batch.num_rows == 1 and total > 2 * step
            for base, data, offsets in _stretches(data, total, step, length) if long else [(0, data, offsets)]:
                of, anchor, first, last, h = segments(data, offsets, length)
                if not len(of):
                    continue
                seg = _Sums(data, int(offsets[-1])).span(first, last + length)
                ids = batch.column("node").take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(seg.view(np.int64)), ids, pa.array((first - offsets[of] + base).astype(np.int64)), pa.array((last - first + 1).astype(np.int32)), pa.array((anchor - first).astype(np.int32))],
                    names=["anchor", "seg", "node", "at", "n", "back"],
                )

    return map_batches(docs, run, "anchor long, seg long, node long, at long, n int, back int")


# ---------------------------------------------------------------- stages


def _cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The rows of wanted (node, at, n, ...) with their bytes."""
    names = [x for x in wanted.columns if x not in ("node", "at", "n")]
    per_doc = wanted.groupBy("node").agg(F.collect_list(F.struct("at", "n", *names)).alias("parts"))
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    ddl = ", ".join(f"{x} {kinds[x]}" for x in ("node", "at", "n", *names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column("text")[k].as_buffer().to_pybytes()
                parts = batch.column("parts").slice(k, 1).flatten()
                own = {x: pc.struct_field(parts, x) for x in ("at", "n", *names)}
                cut = [raw[a : a + n + length - 1] for a, n in zip(own["at"].to_pylist(), own["n"].to_pylist(), strict=True)]
                ids = pa.array(np.full(len(cut), batch.column("node")[k].as_py(), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([ids, *own.values(), pa.array(cut, pa.binary())], names=["node", *own, "bytes"])

    return map_batches(_with_texts(docs, per_doc, "inner").select("node", "text", "parts"), run, ddl + ", bytes binary")


def _with_texts(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join rows (few documents) to their texts: only those documents' texts are moved."""
    ids = rows.select("node").distinct()
    few = ids.limit(FEW + 1).count() <= FEW
    return docs.join(F.broadcast(ids) if few else ids, "node", "left_semi").join(rows, "node", how)


def _sorted_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """anchor, seg, lo, hi: runs of repeated windows in segments, by suffix sorting of whole anchor groups."""

    def block(rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
        flag = repeated_starts(b"\xff".join(r[2] for r in rows) + b"\xff", length)
        at = 0
        for anchor, seg, raw in rows:
            own = np.concatenate([[False], flag[at : at + len(raw) - length + 1], [False]]).astype(np.int8)
            edge = np.flatnonzero(np.diff(own))
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                yield anchor, seg, lo, hi - 1
            at += len(raw) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size, last, found = 0, None, []

        def flush():
            cols = list(zip(*found, strict=True)) or [[], [], [], []]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], names=["anchor", "seg", "lo", "hi"])

        for batch in batches:
            for anchor, seg, raw in zip(*(batch.column(x).to_pylist() for x in ("anchor", "seg", "bytes")), strict=True):
                if anchor != last and size >= BLOCK_BYTES:
                    found += block(held)
                    held, size = [], 0
                    if len(found) > 5000:
                        yield flush()
                held.append((anchor, seg, raw))
                size, last = size + len(raw), anchor
        if held:
            found += block(held)
        yield flush()

    return map_batches(pieces.select("anchor", "seg", "bytes").repartition("anchor").sortWithinPartitions("anchor"), run, "anchor long, seg long, lo long, hi long")


def _window_hashes(pieces: DataFrame, length: int, core: int) -> DataFrame:
    """anchor, seg, lo, hi, o, h, u of blocks of `core` windows of each piece, or of those in its `only` list.

    o is the block's distance from the anchor in blocks, h the hash of the bytes that every window of the
    full block holds, so equal windows have equal o and h; u the hash of all its bytes and of which windows it has (a segment's
    end cuts blocks short). With core = 1 a block is one window.
    """
    own = [x for x in ("anchor", "seg", "n", "back", "bytes", "only") if x in pieces.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "bytes", BATCH_BYTES):
            data, offsets = buffer_of(batch.column("bytes"))
            sums = _Sums(data, int(offsets[-1]))
            n, back = (np.asarray(batch.column(x)).astype(np.int64) for x in ("n", "back"))
            row = np.repeat(np.arange(len(n)), n)
            w = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
            if "only" in own:
                allowed = np.zeros(len(row) + 1, dtype=np.int64)
                base = np.concatenate([[0], np.cumsum(n)])
                for k, runs in enumerate(batch.column("only").to_pylist()):
                    for r in runs:
                        allowed[base[k] + r["lo"]] += 1
                        allowed[base[k] + r["hi"] + 1] -= 1
                keep = np.cumsum(allowed[:-1]) > 0
                row, w = row[keep], w[keep]
            if not len(row):
                continue
            o = (back[row] - w) // core
            new = np.append(True, (row[1:] != row[:-1]) | (o[1:] != o[:-1]))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(row)) - 1
            row, o, lo, hi = row[first], o[first], w[first], w[last]
            start = offsets[row] + back[row] - core * o
            h = sums.span(start, start - (core - 1) + length)
            u = sums.span(offsets[row] + lo, offsets[row] + hi + length) ^ mix((start - offsets[row] - lo).astype(U64))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(take), batch.column("seg").take(take), pa.array(lo), pa.array(hi), pa.array(o), pa.array(h.view(np.int64)), pa.array(u.view(np.int64))], names=["anchor", "seg", "lo", "hi", "o", "h", "u"])

    return map_batches(pieces.select(*own), run, "anchor long, seg long, lo long, hi long, o long, h long, u long")


def _split_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """anchor, seg, lo, hi of segments of crowded anchors, by counts of hashes that are combined before each shuffle.

    Blocks of the same bytes are one kind; all windows of a kind that stands twice repeat. Where blocks of several kinds share
    bytes, one block of each kind goes on to smaller blocks: what it shares with the others, all of its kind do.
    """
    key = ["anchor", "o", "h"]
    rows, done = pieces, []
    for core in (c for c in CORES if c + 7 <= length):  # the shared bytes are at least eight
        hashes = cut_lineage(_window_hashes(rows, length, core))
        kinds = cut_lineage(hashes.groupBy(*key, "u").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("seg", "lo", "hi")).alias("r")))
        done.append(cut_lineage(hashes.join(kinds.filter("c > 1").select(*key, "u"), [*key, "u"]).select("anchor", "seg", "lo", "hi")))
        several = kinds.groupBy(*key).agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").drop("kinds")
        rest = cut_lineage(kinds.join(several, key).select("anchor", "r.seg", "r.lo", "r.hi"))
        if rest.isEmpty():
            break
        only = rest.groupBy("anchor", "seg").agg(F.collect_list(F.struct("lo", "hi")).alias("only"))  # at most a few
        rows = pieces.join(only, ["anchor", "seg"])
    return reduce(DataFrame.unionAll, done)


def repeated_windows(docs: DataFrame, length: int = 400, most: int = MOST) -> DataFrame:
    """node, lo, hi: runs of window starts in documents (node, text) whose windows also start elsewhere."""
    every = cut_lineage(_scan(docs, length))
    # Written first, so that a skewed side of the join can be split: it need not keep the aggregation's partitions.
    seen = cut_lineage(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
    twice = cut_lineage(every.join(seen, "anchor"))
    kinds = cut_lineage(twice.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("node", "at", "n", "back")).alias("r")))
    sizes = cut_lineage(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"))
    wanted = cut_lineage(kinds.join(sizes, "anchor").select("anchor", "seg", "r.*", "kinds"))
    runs = kinds.filter("c > 1").select("anchor", "seg", F.lit(0).cast("long").alias("lo"), (F.col("r.n") - 1).cast("long").alias("hi"))
    runs = runs.unionAll(_sorted_repeats(_cut_out(docs, wanted.filter(F.col("kinds") <= most).drop("kinds", "back"), length), length))
    crowded = wanted.filter(F.col("kinds") > most).drop("kinds")
    if not crowded.isEmpty():
        runs = runs.unionAll(_split_repeats(cut_lineage(_cut_out(docs, crowded, length)), length))
    return twice.join(runs, ["anchor", "seg"]).select("node", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))


def remove_repeats(docs: DataFrame, length: int = 400, outputs: str = "digests", most: int = MOST) -> DataFrame:
    """Without the bytes of repeated windows.

    "digests": doc_id, n_bytes, n_removed, n_spans, kept_sha256. "text": the rows of docs with their text cut
    (rests of split characters are left out) and n_removed.
    """
    results = ("n_removed", "n_bytes", "n_spans", "kept_sha256", "runs", "node")
    keep = [x for x in docs.columns if x.lower() not in ("doc_id", "text", *results)] if outputs == "text" else []
    every, odd = with_nodes(docs.select("doc_id", "text", *keep))
    plain = every.select("doc_id", "node", F.coalesce("text", F.lit("")).alias("text"))
    copies = None
    if odd:
        # Equal rows count once in the search; all of their windows are known to repeat.
        own = F.col("doc_id").isNotNull() & (F.col("doc_id").cast("long") == F.col("node"))
        rest = cut_lineage(plain.filter(~own).groupBy("node").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("c")))
        copies = rest.filter((F.col("c") > 1) & (F.octet_length("text") >= length)).select("node", F.lit(0).cast("long").alias("lo"), (F.octet_length("text") - length).cast("long").alias("hi"))
        plain = plain.filter(own).select("node", "text").unionAll(rest.select("node", "text"))
    found = repeated_windows(plain.filter(F.octet_length("text") >= length).select("node", "text"), length, most)
    found = found if copies is None else found.unionAll(copies)
    per_doc = cut_lineage(found.groupBy("node").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))
    ids = per_doc.select("node")
    ids = F.broadcast(ids) if ids.count() <= FEW else ids
    rows = every.select("doc_id", "text", *keep, "node")
    whole = rows.join(ids, "node", "left_anti")
    cut = rows.join(ids, "node", "left_semi").join(per_doc, "node")
    if outputs == "text":
        whole = whole.select("doc_id", "text", *keep, F.lit(0).cast("long").alias("n_removed"))
    else:
        text = F.coalesce("text", F.lit(""))
        whole = whole.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed, spans = [], [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                lo, hi = (pc.struct_field(runs.values, x).to_numpy(zero_copy_only=False) for x in ("lo", "hi"))
                delta = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(delta, lo, 1)
                np.add.at(delta, hi + length, -1)
                gone = np.cumsum(delta[:-1]) > 0
                texts.append(raw[~gone].tobytes())
                sizes.append(len(raw))
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(np.append(False, gone).astype(np.int8)) == 1).sum()))
            if outputs == "text":
                own = {"text": pa.array([x.decode(errors="ignore") for x in texts], pa.string()), "n_removed": pa.array(removed, pa.int64())}
                columns = [own[x] if x in own else batch.column(x) for x in kinds]
            else:
                columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in texts])]
            yield pa.RecordBatch.from_arrays(columns, names=list(kinds))
        release()

    return whole.unionAll(cut.mapInArrow(run, whole.schema))
