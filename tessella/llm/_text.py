"""Vectorised kernels over the byte buffer of an Arrow string column.

A batch of texts is one contiguous ``uint8`` buffer with document offsets.
Words, word hashes and shingles are found for the whole batch with a few NumPy
passes, so no Python object exists per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_S33, _S29 = U64(33), U64(29)
_SEED = U64(0x9E3779B97F4A7C15)
#: Masks that keep the first r bytes of a little-endian 8-byte load.
_KEEP = np.array([(1 << (8 * r)) - 1 for r in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    h = h ^ (h >> _S33)
    h *= _M1
    h ^= h >> _S29
    h *= _M2
    h ^= h >> _S33
    return h


def text_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int, max_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of each hold about max_bytes (one longer text stays alone) in at most max_rows rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
        total = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = min(start + max_rows, max(start + 1, int(np.searchsorted(total, base + max_bytes, side="right"))))
            yield batch.slice(start, end - start)
            start = end


def balanced_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Record batches joined and cut so that the texts of each but the last hold about max_bytes; one longer text stays alone."""
    held, size = [], 0
    for batch in text_batches(batches, column, max_bytes):
        own = pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held and size + own > max_bytes:
            yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column with 16 zero bytes behind them, and its offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count or column.type != pa.large_binary() else column
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.zeros(int(offsets[-1] - offsets[0]) + 16, dtype=np.uint8)
    if n and len(data) > 16:
        data[:-16] = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def loads(data: np.ndarray) -> np.ndarray:
    """Little-endian 8-byte loads at every position of a padded buffer."""
    return np.ndarray(shape=(len(data) - 8,), dtype="<u8", buffer=data.data, strides=(1,))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
LETTER_DIGIT = np.ones(256, dtype=bool)
LETTER_DIGIT[:0x30] = LETTER_DIGIT[0x3A:0x61] = LETTER_DIGIT[0x7B:0x80] = False


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a batch, and the index of each document's first word (n + 1 entries)."""
    total = int(offsets[-1])
    mask = np.zeros(total + 1, dtype=bool)
    mask[:total] = inside[data[:total]]
    start = mask.copy()
    start[1:] &= ~mask[:-1]
    end = mask.copy()
    end[:-1] &= ~mask[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < total)]
    start[cut] = mask[cut]
    end[cut - 1] = mask[cut - 1]
    begins = np.flatnonzero(start)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(begins, offsets)


def span_hash(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time over all spans together."""
    load = loads(data)
    size = ends - begins
    h = mix(size.astype(np.uint64) * _SEED + _M1)
    first = load[begins] & _KEEP[np.minimum(size, 8)]
    h = mix(h ^ first)
    active, at = np.flatnonzero(size > 8), 8
    while len(active):
        left = size[active] - at
        h[active] = mix((h[active] ^ (load[begins[active] + at] & _KEEP[np.minimum(left, 8)])) * _SEED)
        active, at = active[left > 8], at + 8
    return h


def shingle_hash(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's shingles of `width` words, and their offsets.

    A document of fewer words, but not none, has one shingle: its whole sequence.
    """
    n_words = np.diff(first)
    counts = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(n_words.dtype))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(offsets[-1]), dtype=np.uint64)
    if len(words) >= width:
        h = words[: len(words) - width + 1].copy()
        for k in range(1, width):
            h = mix(h * _SEED + words[k : len(words) - width + 1 + k])
        long = n_words >= width
        which = np.repeat(np.arange(len(n_words))[long], counts[long])
        rank = np.arange(len(which)) - np.repeat(np.concatenate([[0], np.cumsum(counts[long])])[:-1], counts[long])
        out[offsets[which] + rank] = h[first[which] + rank]
    for n in range(1, width):
        few = np.flatnonzero(n_words == n)
        h = np.full(len(few), 0xABCD, dtype=U64) * _SEED + U64(n)
        for k in range(n):
            h = mix(h * _SEED + words[first[few] + k])
        out[offsets[few]] = h
    return out, offsets
