"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to length one; equal ones form a class that one vector stands
for. The second moments of all vectors give an orthonormal basis in descending
order of energy. A tree of median splits along its leading axes, drawn from a
bounded sample, deals the classes to blocks of about `block` vectors; a block that
still holds more is cut by a hash. Two blocks meet only if the boxes of their
coordinates allow a cosine of the threshold.

Blocks meet twice. First with codes only: the leading sixteen coordinates in single precision and the
norms of what is left behind the eighth and the sixteenth. Tile by tile the partial product plus the
product of the suffix norms bounds the cosine, and a tile pair stops as soon as no pair in
it can reach the threshold. Only vectors with a partner that the bound leaves over travel whole to a second meeting,
where the remaining dimensions are accumulated with the same stops and the cosine is computed on the given vectors in
double precision. A task returns the number of links of each vector and a spanning forest of them, so dense families
do not give all pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing (n_links 0, own component); vectors of different
dimensions never link; equal vectors are linked with each other; labels and other
columns are ignored; rows are told apart by vec_id, and by vec_id and vector where the vec_id is null or repeated: such
rows are vectors like any others, component_id is the least vec_id of the linked rows (null if none has one, and then all
of them are kept).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._spark import cut_lineage, map_batches, with_nodes

BLOCK = 8192
#: Bytes of whole vectors that a block may hold, whatever their dimension.
BLOCK_BYTES = 32 << 20
TILE = 256
SAMPLE_ROWS = 20_000
#: Leading axes after which a tile pair is judged; those of a vector's code.
STAGES, CODE = (8, 16, 32), (8, 16)
#: Rounding of a bound in double and in single precision.
_SLACK, _SINGLE = 1e-9, 1e-5


def _unit(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision, None for those that link with nothing."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = v.values
        if x is None or not len(x) or x.null_count:
            out.append(None)
            continue
        x = np.asarray(x, dtype=np.float64)
        top = np.abs(x).max() if np.isfinite(x).all() else 0.0
        if not top:
            out.append(None)
            continue
        x = x / top
        out.append(x / np.sqrt(x @ x))
    return out


def _classes(vectors: DataFrame) -> DataFrame:
    """vec_id, node, key (digest of the unit vector, null without), unit (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [None if u is None else (u + 0.0).tobytes() for u in _unit(batch.column("embedding"))]
            keys = [None if u is None else hashlib.blake2b(u, digest_size=16).digest() for u in units]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("node"), pa.array(keys, pa.binary()), pa.array(units, pa.binary())], names=["vec_id", "node", "key", "unit"])

    return map_batches(vectors, run, "vec_id long, node long, key binary, unit binary")


def _basis(classes: DataFrame, dims: int) -> np.ndarray:
    """Axes of descending energy, as columns; moments are added up where the vectors are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("unit").to_pylist())).reshape(-1, dims)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["at", "s"])

    moments = np.zeros(dims * dims)
    for r in map_batches(classes.select("unit"), run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():  # dims * dims rows
        moments[r.at] = r.s
    _, axes = np.linalg.eigh(moments.reshape(dims, dims))
    return np.ascontiguousarray(axes[:, ::-1])


def _splits(sample: np.ndarray, levels: int) -> list[tuple[int, float]]:
    """Median splits (axis, place) of a tree in heap order; axis -1 for a cell without spread."""
    tree: list[tuple[int, float]] = []
    cells = [np.arange(len(sample))]
    for node in range((1 << levels) - 1):
        own = sample[cells[node]]
        axis, place = -1, 0.0
        if len(own) > 1 and (spread := own.std(axis=0)).max() > 0:
            axis = int(np.argmax(spread))
            place = float(np.median(own[:, axis]))
        left = own[:, axis] <= place if axis >= 0 else np.zeros(len(own), bool)
        tree.append((axis, place))
        cells += [cells[node][left], cells[node][~left]]
    return tree


def _leaf(coords: np.ndarray, tree: list[tuple[int, float]], levels: int) -> np.ndarray:
    node = np.zeros(len(coords), dtype=np.int64)
    axes, places = np.array([t[0] for t in tree] or [-1]), np.array([t[1] for t in tree] or [0.0])
    for _ in range(levels):
        axis = axes[node]
        left = (axis >= 0) & (coords[np.arange(len(coords)), np.maximum(axis, 0)] <= places[node])
        node = 2 * node + np.where(left, 1, 2)
    return node - ((1 << levels) - 1)


def compare(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of x, rows of y) with cosine >= threshold, tile pair by tile pair (row < row if same)."""
    rx, ry = x @ axes, y @ axes
    ox = np.argsort(rx[:, 0], kind="stable")
    oy = ox if same else np.argsort(ry[:, 0], kind="stable")
    dims = x.shape[1]
    stages = [s for s in STAGES if s < dims] + [dims]
    tails = [[np.sqrt(np.maximum(0, 1 - (r[:, :s] ** 2).sum(axis=1))) for s in stages] for r in (rx, ry)]
    for i in range(0, len(ox), TILE):
        a = ox[i : i + TILE]
        for j in range(i if same else 0, len(oy), TILE):
            b = oy[j : j + TILE]
            part, done, live = np.zeros((len(a), len(b))), 0, None
            for k, s in enumerate(stages):
                part += rx[a, done:s] @ ry[b, done:s].T
                done = s
                live = part + tails[0][k][a, None] * tails[1][k][None, b] >= threshold - _SLACK
                hits = int(live.sum())
                if not hits or hits * 16 < live.size:
                    break
            if not hits:
                continue
            p, q = np.nonzero(live)
            p, q = a[p], b[q]
            if same:
                keep = (p < q) | (i != j)
                p, q = np.minimum(p, q)[keep], np.maximum(p, q)[keep]
            sure = np.zeros(len(p), dtype=bool)
            for c in range(0, len(p), 65536):
                sure[c : c + 65536] = np.einsum("ij,ij->i", x[p[c : c + 65536]], y[q[c : c + 65536]]) >= threshold
            yield p[sure], q[sure]


def code_of(coords: np.ndarray) -> np.ndarray:
    """The code of each vector from its coordinates: leading ones, then the norms behind each stage."""
    stages = [min(c, coords.shape[1]) for c in CODE]
    tails = [np.sqrt(np.maximum(0, 1 - (coords[:, :s] ** 2).sum(axis=1, keepdims=True))) for s in stages]
    return np.hstack([coords[:, : stages[-1]], *tails]).astype(np.float32)


def possible(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of x and of y have a partner that the bounds of their codes do not rule out (itself is none)."""
    width = x.shape[1] - len(CODE)
    stages = [min(c, width) for c in CODE]
    ox = np.argsort(x[:, 0], kind="stable")
    oy = ox if same else np.argsort(y[:, 0], kind="stable")
    some_x, some_y = np.zeros(len(x), dtype=bool), np.zeros(len(y), dtype=bool)
    for i in range(0, len(ox), TILE):
        a = ox[i : i + TILE]
        for j in range(i if same else 0, len(oy), TILE):
            b = oy[j : j + TILE]
            part, done, live = np.zeros((len(a), len(b)), dtype=np.float32), 0, None
            for k, s in enumerate(stages):
                part += x[a, done:s] @ y[b, done:s].T
                done = s
                live = part + x[a, width + k, None] * y[None, b, width + k] >= threshold - _SINGLE
                if same and i == j:
                    np.fill_diagonal(live, False)
                if not live.any():
                    break
            else:
                some_x[a] |= live.any(axis=1)
                some_y[b] |= live.any(axis=0)
    return (some_x | some_y,) * 2 if same else (some_x, some_y)


class _Forest:
    """Union-find over the rows of a task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def spanning(self, p: np.ndarray, q: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for i, j in zip(p.tolist(), q.tolist(), strict=True):
            a, b = self.root(i), self.root(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                out.append((i, j))
        return out


def link_vectors(vectors: DataFrame, threshold: float = 0.95, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, embedding)."""
    nodes, odd = with_nodes(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "embedding", id_col="vec_id")
    classes = cut_lineage(_classes(nodes.select("vec_id", "node", "embedding")))
    first = classes.filter("key is not null").groupBy("key").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("copies"))
    member = cut_lineage(classes.join(first, "key", "left").select("vec_id", "node", F.coalesce("rep", "node").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies"), F.when(F.col("node") == F.col("rep"), F.col("unit")).alias("unit")))
    reps = member.filter("unit is not null").select("rep", "copies", "unit", F.octet_length("unit").alias("size")).dropDuplicates(["rep"])
    counts, links = None, None
    for size in sorted(r["size"] for r in reps.select("size").distinct().collect()):
        c, e = _compare_all(reps.filter(F.col("size") == size), size // 8, threshold, block)
        counts, links = (c, e) if counts is None else (counts.unionAll(c), links.unionAll(e))
    if counts is None:
        return member.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    others = counts.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(links).withColumnRenamed("node", "rep")
    out = member.drop("unit").join(others, "rep", "left").join(parts, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    if odd:
        out = out.join(out.groupBy("component").agg(F.min("vec_id").alias("component_id")), "component")
    else:
        out = out.withColumn("component_id", F.col("component"))
    own = F.col("component_id")
    return out.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id", F.coalesce(own == F.col("vec_id"), own.isNull()).alias("kept"))


def _compare_all(reps: DataFrame, dims: int, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(rep, links) partial counts and (a, b) links of a spanning forest, of unit vectors of one dimension."""
    axes = _basis(reps, dims)
    n = reps.count()
    block = max(16, min(block, BLOCK_BYTES // (8 * dims)))
    lead = axes[:, : min(8, dims)]
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    sample = reps.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < share * (1 << 20)).select("unit").limit(2 * SAMPLE_ROWS)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("unit").to_pylist())).reshape(-1, dims) @ lead
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in x], pa.binary())], names=["c"])

    coords = np.array([np.frombuffer(r.c) for r in map_batches(sample, project, "c binary").collect()]).reshape(-1, lead.shape[1])
    levels = min(14, max(0, int(np.ceil(np.log2(max(1, n / block))))))
    tree = _splits(coords, levels)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("unit").to_pylist())).reshape(-1, dims) @ axes
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([c.tobytes() for c in code_of(x)], pa.binary()), pa.array(_leaf(x, tree, levels))], names=["rep", "code", "leaf"])

    dealt = cut_lineage(map_batches(reps.select("rep", "unit"), deal, "rep long, code binary, leaf long"))
    crowd = dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("m"))
    # A leaf of more than the wanted size is cut by a hash, so no block grows with its neighbourhood.
    dealt = cut_lineage(dealt.join(crowd, "leaf").withColumn("block", F.concat_ws(".", "leaf", F.pmod(F.xxhash64("rep"), F.ceil(F.col("m") / F.lit(block))))).drop("leaf", "m"))
    width = min(CODE[-1], dims)

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row of a block and batch: the least and the largest coordinates of the codes."""
        for batch in batches:
            if not batch.num_rows:
                continue
            r = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.float32).reshape(-1, width + len(CODE))
            coded = batch.column("block").dictionary_encode()
            which = coded.indices.to_numpy()
            for k, name in enumerate(coded.dictionary.to_pylist()):
                own = r[which == k]
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([own.min(axis=0).astype(np.float64)], pa.list_(pa.float64())), pa.array([own.max(axis=0).astype(np.float64)], pa.list_(pa.float64()))], names=["block", "low", "high"])

    per_axis = map_batches(dealt.select("block", "code"), box, "block string, low array<double>, high array<double>").select("block", F.posexplode(F.arrays_zip("low", "high")).alias("axis", "x"))
    least = per_axis.groupBy("block", "axis").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    # One row of some 300 bytes for each block of thousands of vectors.
    boxes = least.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("b")).orderBy("block").collect()
    names = [r.block for r in boxes]
    low, high = (np.array([[x[k] for x in r.b] for r in boxes]).reshape(len(boxes), -1) for k in (1, 2))
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast((names, low, high))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, low, high = shared.value
        for batch in batches:
            for i in batch.column("id").to_pylist():
                a, b = (slice(None), slice(0, width)), -1
                best = np.maximum(np.maximum(low[i] * low[i:], low[i] * high[i:]), np.maximum(high[i] * low[i:], high[i] * high[i:]))
                near = i + np.flatnonzero(best[a].sum(axis=1) + best[:, b] >= threshold - _SINGLE)
                near = np.union1d(near, [i])
                yield pa.RecordBatch.from_arrays([pa.array([names[i]] * len(near)), pa.array([names[j] for j in near])], names=["x", "y"])

    pairs = cut_lineage(map_batches(spark.range(len(names)), meet, "x string, y string"))
    sides = pairs.select("x", "y", F.col("x").alias("block"), F.lit(0).alias("side")).unionAll(pairs.filter("x <> y").select("x", "y", F.col("y").alias("block"), F.lit(1).alias("side")))

    def judge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        own = [rows[rows["side"] == s] for s in (0, 0 if same else 1)]
        x, y = (np.frombuffer(b"".join(o["code"]), np.float32).reshape(-1, width + len(CODE)) for o in own)
        keep = possible(x, y, threshold, same)
        kept = [o[k] for o, k in zip(own, keep, strict=True)][: 1 if same else 2]
        return pd.concat(kept)[["rep", "side"]].assign(x=key[0], y=key[1])

    whole = reps.select("rep", "copies", "unit")
    chosen = dealt.join(sides, "block").groupBy("x", "y").applyInPandas(judge, "rep long, side int, x string, y string")
    met = cut_lineage(chosen).join(whole, "rep")

    def join_blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        own = [rows[rows["side"] == s] for s in (0, 0 if same else 1)]
        if not all(map(len, own)):
            return pd.DataFrame({"rep": [], "links": [], "b": pd.array([], dtype="Int64")})
        x, y = (np.frombuffer(b"".join(o["unit"])).reshape(-1, dims) for o in own)
        (ids, idy), (cx, cy) = ([o["rep"].to_numpy() for o in own], [o["copies"].to_numpy() for o in own])
        nx, ny = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
        forest, edges = _Forest(len(x) + (0 if same else len(y))), []
        for p, q in compare(x, y, axes, threshold, same):
            np.add.at(nx, p, cy[q])
            np.add.at(ny, q, cx[p])
            edges += [(int(ids[i]), int(idy[j - (0 if same else len(x))])) for i, j in forest.spanning(p, q + (0 if same else len(x)))]
        if same:
            nx, ny = nx + ny, np.zeros(0, dtype=np.int64)
            idy = idy[:0]
        reps_, links = np.concatenate([ids, idy]), np.concatenate([nx, ny])
        some = links > 0
        out = pd.DataFrame({"rep": reps_[some], "links": links[some], "b": pd.array([None] * int(some.sum()), dtype="Int64")})
        if edges:
            out = pd.concat([out, pd.DataFrame({"rep": [e[0] for e in edges], "links": 0, "b": pd.array([e[1] for e in edges], dtype="Int64")})])
        return out

    found = cut_lineage(met.groupBy("x", "y").applyInPandas(join_blocks, "rep long, links long, b long"))
    return found.filter("b is null").select("rep", "links"), found.filter("b is not null").select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b"))
