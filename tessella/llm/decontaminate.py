"""Benchmark decontamination: Wu-Manber search for many strings at once.

Texts and items are lower-cased (A-Z) and reduced to words; every window of ten
consecutive item words (all words of a shorter item) is a pattern, spelled as
its words with one space around each, so that an occurrence begins and ends at
word borders. Patterns are grouped by length. In each group, with m its shortest
length, a shift table over hashed blocks tells how far the search may move on
because no pattern can end its first m bytes there; positions of shift 0 are
looked up by the value of that last block, and the patterns of that bucket are
compared byte by byte. Many cursors, one for each chunk of a batch, move in
step, so each round of moves is a handful of NumPy operations.

Patterns stand in one buffer of the items' words, as places and sizes, so that
a window costs some tens of bytes and not a Python object. Items are broadcast, at
most `pass_bytes` of their text at a time; a larger benchmark is searched in
several passes whose hits are united document by document.

Defined cases: null and empty texts have no words; items without words are never
found; items with equal windows are all named; a row of `benchmark` that repeats
an item_id is the same item; rows of docs with null or repeated doc_id are told apart
by their texts; empty tables give no items or no rows; other columns pass
through, result columns (and `node` and `hit_places` in several passes) win on clashing names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import crc_mod, map_texts, with_nodes
from ._text import _KEEP, LETTER_DIGIT, LOWER, U64, buffer_of, loads, mix, span_hash, text_batches, word_spans

BATCH_BYTES = 2 << 20
#: Item text of a pass; its tables take about six times as much in a worker.
PASS_BYTES = 8 << 20
_CHUNK = 2048
_BITS = 20
#: Bytes of a pattern that shift tables look at.
_FARTHEST = 1 << 12
_MULT = U64(0x9E3779B97F4A7C15)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, places of the space before each word, places of the one behind it, first word of each document).

    Each document is its words with one space before each and one behind the last; where documents
    meet there are two spaces, which no pattern holds.
    """
    begins, ends, first = word_spans(data, offsets, LETTER_DIGIT)
    size = ends - begins
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    place = np.concatenate([[0], np.cumsum(size + 1)])[:-1] + doc
    out = np.full(int(size.sum()) + len(size) + len(offsets) + 16, 0x20, dtype=np.uint8)
    src = np.repeat(begins - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(int(size.sum()))
    out[src + np.repeat(place + 1 - begins, size)] = data[src]
    return out, place, place + 1 + size, first


@dataclass
class _Group:
    """Patterns of like lengths in the order of the block that ends their first `shortest` bytes."""

    block: int
    shortest: int
    shift: np.ndarray
    values: np.ndarray
    pattern: np.ndarray


class WuManber:
    """Shift tables and buckets of byte strings, which are spans of one padded buffer."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.raw, self.start, self.size = buffer.tobytes(), start, size
        self.head = loads(buffer)[start]
        self.groups = []
        for low, high, block in ((2, 12, 2), (12, 28, 4), (28, 1 << 60, 8)):
            if len(own := np.flatnonzero((size >= low) & (size < high))):
                self.groups.append(self._group(loads(buffer), own, block))

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return ((values * _MULT) >> U64(64 - _BITS)).astype(np.int64)

    def _group(self, load: np.ndarray, own: np.ndarray, block: int) -> _Group:
        shortest = int(min(self.size[own].min(), _FARTHEST))
        start, mask = self.start[own], _KEEP[block]
        shift = np.full(1 << _BITS, shortest - block + 1, dtype=np.int16)
        for at in range(shortest - block + 1):  # ever smaller shifts
            shift[self._slot(load[start + at] & mask)] = shortest - block - at
        values = load[start + shortest - block] & mask
        order = np.argsort(values, kind="stable")
        return _Group(block, shortest, shift, values[order], own[order].astype(np.int32))

    def search(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, pattern) of every occurrence in a buffer with 16 bytes of padding."""
        raw, total = text.tobytes(), len(text) - 16
        load = loads(text)
        for g in self.groups:
            last = total - g.shortest
            if last < 0:
                continue
            mask, back = _KEEP[g.block], g.shortest - g.block
            cursor = np.arange(0, last + 1, _CHUNK)
            stop = np.minimum(cursor + _CHUNK, last + 1)
            while len(cursor):
                value = load[cursor + back] & mask
                move = g.shift[self._slot(value)].astype(np.int64)
                if len(found := np.flatnonzero(move == 0)):
                    yield from self._confirm(raw, load, g, cursor[found], value[found])
                    move[found] = 1
                cursor = cursor + move
                if not (keep := cursor < stop).all():
                    cursor, stop = cursor[keep], stop[keep]

    def _confirm(self, raw: bytes, load: np.ndarray, g: _Group, at: np.ndarray, value: np.ndarray) -> Iterator[tuple[int, int]]:
        """The patterns of the buckets of `value` that stand at `at`."""
        low, high = np.searchsorted(g.values, value, side="left"), np.searchsorted(g.values, value, side="right")
        some = high - low
        at = np.repeat(at, some)
        which = g.pattern[np.repeat(low - np.concatenate([[0], np.cumsum(some)])[:-1], some) + np.arange(int(some.sum()))]
        keep = _KEEP[np.minimum(self.size[which], 8)]
        like = np.flatnonzero((load[at] ^ self.head[which]) & keep == 0)
        for a, p in zip(at[like].tolist(), which[like].tolist(), strict=True):
            s, n = self.start[p], self.size[p]
            if raw.startswith(self.raw[s : s + n], a):
                yield a, p


def windows(place: np.ndarray, stop: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, item) of every window of `width` words, of all words of a shorter item."""
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    item = np.repeat(np.arange(len(n)), count)
    head = first[item] + np.arange(len(item)) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
    return place[head], stop[head + np.minimum(n[item], width) - 1] + 1, item


class Matcher:
    """Finds the items of one pass in batches of texts."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        of = np.array([number[i] for i, _ in items], dtype=np.int32)
        data, offsets = buffer_of(pa.array([t for _, t in items], pa.string()))
        out, place, stop, first = normalise(LOWER[data], offsets)
        start, end, item = windows(place, stop, first, width)
        # Equal windows are one pattern of several items; 128 bits of hash tell them apart.
        h = np.stack([span_hash(out, start, end), span_hash(out, start, end - (end - start) // 2)])
        order = np.lexsort((of[item], h[1], h[0]))
        h, item = h[:, order], of[item][order]
        new = np.append(True, (h[:, 1:] != h[:, :-1]).any(axis=0))[: len(order)]
        lead = order[new]
        self.first_item = np.append(np.flatnonzero(new), len(order))
        self.items = item
        self.words = np.searchsorted(place, end[lead] - 1) - np.searchsorted(place, start[lead])
        self.search = WuManber(out, start[lead], end[lead] - start[lead]).search

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[str]]]:
        """(words, first word of each document, hit words, found items)."""
        data, offsets = buffer_of(column)
        text, place, _, first = normalise(LOWER[data], offsets)
        delta = np.zeros(len(place) + 1, dtype=np.int64)
        found: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        got = list(self.search(text))
        if got:
            at = np.searchsorted(place, [x for x, _ in got])
            which = np.array([p for _, p in got])
            np.add.at(delta, at, 1)
            np.add.at(delta, at + self.words[which], -1)
            for d, p in set(zip((np.searchsorted(first, at, side="right") - 1).tolist(), which.tolist(), strict=True)):
                found[d].update(self.ids[k] for k in self.items[self.first_item[p] : self.first_item[p + 1]].tolist())
        return np.diff(first), first, np.cumsum(delta[:-1]) > 0, found


_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, items: list[tuple[str, str]], width: int) -> Matcher:
    """The worker's matcher of a pass; one is kept."""
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, width)
    return _MATCHERS[key]


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def find_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = 10, text_col: str = "text", keep_text: bool = False, pass_bytes: int = PASS_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Each row with n_words, n_hit, n_items, items (sorted ids), items_sha256 and contaminated."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")).filter("item_id is not null and text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    passes = max(1, math.ceil(total / pass_bytes))
    rows = docs if passes == 1 else with_nodes(docs, text_col)[0]

    def searched(part: int) -> DataFrame:
        own = [(r.item_id, r.text) for r in (items if passes == 1 else items.filter(crc_mod("item_id", passes) == part)).toLocalIterator()]
        shared = spark.sparkContext.broadcast(own)
        key = hashlib.sha256(repr((width, sorted(own))).encode()).hexdigest()

        def run(batches: Iterator[pa.RecordBatch]):
            matcher = _matcher(key, shared.value, width)
            for batch in text_batches(batches, text_col, batch_bytes):
                n_words, first, hit, found = matcher.batch(batch.column(text_col))
                at = np.concatenate([[0], np.cumsum(hit)])
                n_hit = at[first[1:]] - at[first[:-1]]
                columns = [pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in found], pa.int64()), pa.array([sorted(x) for x in found], pa.list_(pa.string())), pa.array([digest(x) for x in found]), pa.array(n_hit > 0)]
                if passes > 1:
                    columns.append(pa.array([np.flatnonzero(hit[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)], pa.list_(pa.int64())))
                yield batch, columns

        ddl = "n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean"
        return map_texts(rows, text_col, run, ddl + (", hit_places array<long>" if passes > 1 else ""), keep_text)

    if passes == 1:
        return searched(0)
    first = searched(0)
    more = first.select("node", "hit_places", "items")
    for part in range(1, passes):
        more = more.unionByName(searched(part).filter("contaminated").select("node", "hit_places", "items"))
    both = more.groupBy("node").agg(F.size(F.array_distinct(F.flatten(F.collect_set("hit_places")))).cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = first.drop("hit_places", "n_hit", "n_items", "items", "items_sha256", "contaminated").join(both, "node").drop("node")
    return out.withColumns({"n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ",").cast("binary"), 256), "contaminated": F.col("n_hit") > 0})
