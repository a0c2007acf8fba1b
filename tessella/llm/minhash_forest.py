"""Near-duplicate documents by MinHash and an LSH forest.

A document is the set of its five-word shingles. Documents of equal sets form a
class, and one document stands for each class. A signature of minima, one for
each of `trees * length` hash functions, gives every class `trees` sorted orders:
the signature's parts. Neighbours in an order are those of the longest common
prefix: classes that share the first `depth` minima are one region, a run of the order. A run is brought together by its
prefix, as a key of the shuffle, so no order need be laid out from end to end and none is cut at a task's border. In a region
of at most `small` classes all pairs are candidates. A larger region is cut
deeper, by 4, 6 and then all 8 minima, until its parts are small; beside that
every class of a large region is compared with the region's centre, the class
whose whole parts are the most common (in a family of edited copies, the
original). Classes that are not found to be linked with their centre meet again
in rounds, with new centres, for as long as a round finds links. That only saves work:
at the end the classes of all large regions that hold more than one component go through
an exact prefix-filter join, which finds every similar pair of different components.

Candidates are confirmed on full shingle sets: 100 * intersection >= percent * union.
At 14 trees and depth 3 a pair of similarity 0.85 is missed with probability 1.2e-6.

Defined cases: null, empty and wordless texts have empty sets and are linked with
nothing; a text of fewer than five words is one shingle; rows are told apart by
doc_id, and by doc_id and text where the doc_id is null or repeated: such rows are
documents like any others, component_id is the least doc_id of the linked
rows (null if none has one, and then all of them are kept); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._spark import FEW, cut_lineage, map_batches, with_nodes
from ._text import LOWER, NOT_SPACE, U64, buffer_of, mix, shingle_hash, span_hash, text_batches, word_spans

TREES, LENGTH, DEPTHS, SMALL = 14, 8, (3, 4, 6, 8), 16
SHINGLE = 5
BATCH_BYTES = 1 << 20
#: Counters of shingles by hash, which order a set from rare to common (any order is exact, a good one makes few candidates).
SLOTS = 1 << 20


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, and their offsets."""
    data, offsets = buffer_of(texts)
    data = LOWER[data]
    begins, ends, first = word_spans(data, offsets, NOT_SPACE)
    shingles, at = shingle_hash(span_hash(data, begins, ends), first, width)
    if not len(shingles):
        return shingles, at
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        shingles[a:b].sort()
    new = np.append(True, shingles[1:] != shingles[:-1])
    new[at[:-1][at[:-1] < len(new)]] = True
    return shingles[new], np.concatenate([[0], np.cumsum(new)])[at]


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0xD1342543DE82EF95))
    return x[:n] | U64(1), x[n:]


def signatures(sets: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n 32-bit minima of each set (rows of empty sets are all ones)."""
    out = np.full((len(at) - 1, n), 0xFFFFFFFF, dtype=np.uint32)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        times, flip = _multipliers(n)
        starts = at[:-1][some]
        for k in range(n):
            out[some, k] = np.minimum.reduceat(((sets ^ flip[k]) * times[k]) >> U64(32), starts)
    return out


def _sign(docs: DataFrame, width: int, trees: int, length: int) -> DataFrame:
    """doc_id, node, n, a 128-bit digest of the set in s1 and s2, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            sets, at = shingle_sets(batch.column("text"), width)
            n = np.diff(at)
            digest = np.zeros((2, len(n)), dtype=U64)
            some = np.flatnonzero(n > 0)
            if len(some):
                for k in range(2):
                    digest[k, some] = np.add.reduceat(mix(sets ^ U64(0x5851F42D4C957F2D + k)), at[:-1][some])
            sig = np.ascontiguousarray(signatures(sets, at, trees * length).astype(">u4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("node"), pa.array(n.astype(np.int64)), *(pa.array(x.view(np.int64)) for x in digest), pa.array([x.tobytes() for x in sig], pa.binary())],
                names=["doc_id", "node", "n", "s1", "s2", "sig"],
            )

    return map_batches(docs, run, "doc_id long, node long, n long, s1 long, s2 long, sig binary")


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ids = cut_lineage(pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct())
    small = ids.count() <= FEW
    texts = docs.select(F.col("node").alias("id"), "text").join(F.broadcast(ids) if small else ids, "id", "left_semi").dropDuplicates(["id"])
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [batch.column(x).dictionary_encode() for x in ("ta", "tb")]
            (left, la), (right, ra) = (shingle_sets(c.dictionary.cast(pa.string()), width) for c in coded)
            keep = []
            for i, j in zip(*(c.indices.to_pylist() for c in coded), strict=True):
                x, y = left[la[i] : la[i + 1]], right[ra[j] : ra[j + 1]]
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                z = np.concatenate([x, y])
                z.sort()
                common = int((z[1:] == z[:-1]).sum())
                keep.append(100 * common >= percent * (len(z) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("a", "b", "ta", "tb"), run, "a long, b long")


def _pairs(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """All pairs within groups of a bounded size, of set sizes that a link allows."""
    x, y = (rows.select(key, F.col("rep").alias(r), F.col("n").alias(f"n{r}")) for r in "ab")
    return x.join(y, key).filter((F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b")


def _star(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Every row of a group with the group's centre: the most common one."""
    centre = rows.groupBy(key).agg(F.max(F.struct("pop", (-F.col("rep")).alias("r"), "n")).alias("c")).select(key, (-F.col("c.r")).alias("centre"), F.col("c.n").alias("nc"))
    return (
        rows.join(centre, key)
        .filter((F.col("rep") != F.col("centre")) & (100 * F.least("n", "nc") >= percent * F.greatest("n", "nc")))
        .select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
    )


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """rows with the size of their group, of groups of at least two."""
    return rows.join(rows.groupBy(key).agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), key)


def _prefixes(crowd: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """rep, part, n, token, pos, low: the first shingles of each class of crowd (rep, part), rare ones first.

    A set of n and one of at most n with enough in common have their first common shingle among the first
    n - ceil(percent * n / 100) + 1 of the larger one, and in the rows marked low of the smaller one.
    Shingles of one class only are left out, positions count them.
    """
    few = crowd.count() <= FEW
    texts = docs.select(F.col("node").alias("rep"), "text").join(F.broadcast(crowd) if few else crowd, "rep").select("rep", "part", "text")
    shift = U64(64 - SLOTS.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, dtype=np.int64)
        for batch in text_batches(batches, "text", BATCH_BYTES):
            seen += np.bincount((shingle_sets(batch.column("text"), width)[0] >> shift).astype(np.int64), minlength=SLOTS)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some])], names=["slot", "m"])

    found = map_batches(texts.select("text"), count, "slot int, m long").groupBy("slot").agg(F.sum("m").alias("m")).toArrow()
    table = np.zeros(SLOTS, dtype=np.uint32)
    table[found.column("slot").to_numpy()] = np.minimum(found.column("m").to_numpy(), 0xFFFFFFFF)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in text_batches(batches, "text", BATCH_BYTES):
            sets, at = shingle_sets(batch.column("text"), width)
            size = np.diff(at)
            row = np.repeat(np.arange(len(size)), size)
            m = common[(sets >> shift).astype(np.int64)]
            order = np.lexsort((sets, m, row))
            pos = np.arange(len(sets)) - at[row]
            n = size[row]
            keep = (pos <= n - -(-percent * n // 100)) & (m[order] > 1)
            low = pos <= n - -(-2 * percent * n // (100 + percent))
            row = row[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(row)), batch.column("part").take(pa.array(row)), pa.array(n[keep].astype(np.int32)), pa.array(sets[order][keep].view(np.int64)), pa.array(pos[keep].astype(np.int32)), pa.array(low[keep])],
                names=["rep", "part", "n", "token", "pos", "low"],
            )

    return map_batches(texts, first, "rep long, part long, n int, token long, pos int, low boolean")


def _across(crowd: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Candidates (a, b) of different parts of crowd (rep, part): no similar pair is missing."""
    rows = cut_lineage(_prefixes(crowd, docs, percent, width))
    mixed = rows.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("token")
    rows = cut_lineage(rows.join(mixed, "token"))
    x, y = (r.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "part", "n", "pos"))) for r, s in ((rows, "x"), (rows.filter("low"), "y")))
    smaller = (F.col("n_y") < F.col("n_x")) | ((F.col("n_y") == F.col("n_x")) & (F.col("rep_y") < F.col("rep_x")))
    # What is left of both sets from their first common shingle on must hold all that they need in common.
    enough = (100 + percent) * F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")).cast("long") >= percent * (F.col("n_x") + F.col("n_y")).cast("long")
    pairs = x.join(y, (x["token"] == y["token"]) & (F.col("part_x") != F.col("part_y")) & smaller & (100 * F.col("n_y").cast("long") >= percent * F.col("n_x").cast("long")) & enough)
    return pairs.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def link_documents(docs: DataFrame, percent: int = 85, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text)."""
    nodes, odd = with_nodes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    linked = link_nodes(nodes, percent, **options)
    if odd:
        # A node need not be a doc_id here: a component goes by the least doc_id of its rows.
        names = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        linked = linked.join(names, "component")
    else:
        linked = linked.withColumn("component_id", F.col("component"))
    return linked.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def extra_copies(docs: DataFrame, percent: int = 85, **options) -> DataFrame:
    """The nodes of docs (doc_id, node, text) that are linked with another one that stands for their component."""
    linked = link_nodes(docs, percent, **options)
    first = linked.filter("component <> node").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("f"))
    own = F.col("component")
    ahead = linked.filter("component = node").select("component", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node").alias("g"))
    stays = first.join(ahead, "component").select(own, F.least("f", "g")["node"].alias("stays"))
    return linked.join(stays, "component").filter("node <> stays").select("node").distinct()


def link_nodes(docs: DataFrame, percent: int = 85, width: int = SHINGLE, trees: int = TREES, length: int = LENGTH, depths: tuple[int, ...] = DEPTHS, small: int = SMALL) -> DataFrame:
    """doc_id, node, n_shingles and component (a node of the linked ones) for every row of docs (doc_id, node, text)."""
    docs = docs.select("doc_id", "node", "text")
    signed = cut_lineage(_sign(docs, width, trees, length))
    first = signed.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("node").alias("rep"))
    member = cut_lineage(
        signed.join(first, ["s1", "s2", "n"], "left").select("doc_id", "node", F.col("n").alias("n_shingles"), F.coalesce("rep", "node").alias("rep"), F.when(F.col("node") == F.col("rep"), F.col("sig")).alias("sig"))
    )
    reps = member.filter("sig is not null").select("rep", F.col("n_shingles").alias("n"), "sig").dropDuplicates(["rep"])

    def key(depth: int):
        return F.xxhash64("t", F.substring("sig", F.col("t") * (4 * length) + 1, 4 * depth))

    spread = reps.select("rep", "n", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("t"), "sig").select("rep", "n", "t", key(depths[0]).alias("k0"))
    near = cut_lineage(_counted(spread, "k0"))
    found = [_pairs(near.filter(F.col("m") <= small), "k0", percent)]
    large = near.filter(F.col("m") > small).drop("m")
    regions = None
    if not large.isEmpty():
        deep = large.join(reps.select("rep", "sig"), "rep").select("rep", "n", "k0", *(key(d).alias(f"k{i}") for i, d in enumerate(depths[1:], 1)))
        last = f"k{len(depths) - 1}"
        common = _counted(deep.select("rep", last), last).groupBy("rep").agg(F.sum("m").alias("pop"))
        regions = cut_lineage(deep.join(common, "rep", "left").fillna(0, ["pop"]))
        found.append(_star(regions, "k0", percent))
        rows = regions
        for i in range(1, len(depths)):
            sized = _counted(rows, f"k{i}")
            found.append(_pairs(sized.filter(F.col("m") <= small), f"k{i}", percent))
            rows = sized.filter(F.col("m") > small).drop("m")
            found.append(_star(rows, f"k{i}", percent))
    tried = cut_lineage(_union(found).distinct())
    links = cut_lineage(_confirm(tried, docs, percent, width))
    parts = components(links)
    everyone = regions
    while regions is not None:
        # Where a region's classes are not all in one component, those outside its centre's component meet again.
        own = regions.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
        centre = own.groupBy("k0").agg(F.max_by("part", F.struct("pop", (-F.col("rep")).alias("r"))).alias("done"))
        regions = cut_lineage(own.join(centre, "k0").filter("part <> done").drop("done", "part"))
        again = _counted(regions, "k0")
        more = _union([_pairs(again.filter(F.col("m") <= small), "k0", percent), _star(again.filter(F.col("m") > small), "k0", percent)]).distinct().join(tried, ["a", "b"], "left_anti")
        more = cut_lineage(more)
        if more.isEmpty():
            break
        new = cut_lineage(_confirm(more, docs, percent, width))
        if new.isEmpty():
            break
        tried, links = tried.unionAll(more), links.unionAll(new)
        parts = components(links)
    if everyone is not None:
        own = everyone.select("rep", "k0").join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
        mixed = own.groupBy("k0").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("k0")
        crowd = cut_lineage(own.join(mixed, "k0").select("rep", "part").distinct())
        if not crowd.isEmpty():
            more = cut_lineage(_across(crowd, docs, percent, width).join(tried, ["a", "b"], "left_anti"))
            new = cut_lineage(_confirm(more, docs, percent, width))
            if not new.isEmpty():
                parts = components(links.unionAll(new))
    out = member.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", "node", "n_shingles", F.coalesce("component", "rep").alias("component"))
