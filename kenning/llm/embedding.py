"""Embedding near-duplicates by a pigeonhole join of subspaces.

Two unit vectors have cosine >= t exactly if their squared distance is at most 2 - 2t.
Vectors are rotated (by one random rotation per dimension) and split into blocks of
about ``BLOCK`` coordinates, and each block gets the share of the squared distance that
its coordinates have of all: if every block's distance were above its share, so would
the sum be above the whole. So the pairs within the share of at least one block, found
by a range join per block, hold every pair that links, in any dimension. Their union is
verified by the cosine in double precision: no other pair is linked.

The range joins run between tiles: vectors are dealt evenly into tiles of at most about
``TILE_ROWS`` rows and ``TILE_BYTES`` bytes, and every pair of tiles meets once; within
it, a block's distances are one product of matrices in single precision, and whatever is
not beyond the share by more than the proven rounding error is a candidate. Tiles travel
packed, one row each. A pair of tiles returns what is bounded by its vectors, not by its
links: a spanning forest of the links, and for each vector how many it has.

No block of spread-out vectors can be ordered so that a range of it is small (16
coordinates of cosine 0.9 reach most cells of any grid), so the distances of all pairs
of a tile are computed, and the work is the square of the number of distinct vectors;
what the blocks save is the verification. The README has the measured figures.

Equal vectors are collapsed to one class with a count before the join, so a vector
that is repeated without bound costs one row.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (each its own component, also when equal); vectors of
different lengths do not link; a null id is counted as a neighbour but sorts after
all ids; rows that repeat are each returned; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import scratch
from kenning.llm.components import connected_components

THRESHOLD = 0.9
TILE_ROWS = 8192
TILE_BYTES = 64 << 20
# Rows of a tile whose distances are computed together; components of the pairs verified together.
STRIP = 512
PART = 1 << 21
BLOCK = 16
SEED = 7


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> list[tuple[int, int]]:
    """Blocks of about ``BLOCK`` coordinates: four in 64 dimensions, 48 in 768."""
    at = np.linspace(0, dim, max(1, round(dim / BLOCK)) + 1).round().astype(int).tolist()
    return list(zip(at[:-1], at[1:]))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _classes(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, node; null node: links with nothing) and classes (node, vec, n)."""
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vec, lambda x: x != 0)
    ok = F.coalesce(F.size(vec) > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True))
    rows = df.select(F.col(id_col).alias("id"), F.when(F.when(ok, ~zero), vec).alias("vec"))
    # the sum with 0.0 makes -0.0 equal to 0.0
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    rows = scratch(rows.withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))), "vectors")
    classes = rows.where("node is not null").groupBy("node").agg(F.min_by("vec", F.lit(1)).alias("vec"), F.count("*").alias("n"),
                                                                 F.min("id").alias("low"))
    return rows.select("id", "node"), scratch(classes, "vector-classes")


def _sides(rotated: np.ndarray, edges) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per block the two factors (for a left and a right vector) whose product is minus
    half the squared distance of the two in that block."""
    left, right = [], []
    for s, e in edges:
        part = rotated[:, s:e]
        half, one = (part * part).sum(axis=1, keepdims=True) / 2, np.ones((len(part), 1))
        left.append(np.hstack([part, -half, one]).astype(np.float32))
        right.append(np.hstack([part, one, -half]).astype(np.float32))
    return left, right


def candidates(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Positions (in x, in y) of unit vectors that lie within the share of the squared
    distance in some block, strip by strip; ``same``: x is y, and each pair is given once."""
    dim = x.shape[1]
    turn, edges = rotation(dim), block_edges(dim)
    left, _ = _sides(x @ turn, edges)
    _, right = _sides(y @ turn, edges)
    for s in range(0, len(x), STRIP):
        first = s if same else 0
        near = np.zeros((min(STRIP, len(x) - s), len(y) - first), bool)
        for (lo, hi), a, b in zip(edges, left, right):
            # the share, and the rounding of factors and products in single precision, doubled
            share = (2 - 2 * threshold) * (hi - lo) / dim
            near |= a[s:s + STRIP] @ b[first:].T >= np.float32(-share / 2 - (hi - lo + 8) * 2.0 ** -22)
        a, b = np.nonzero(near)
        a, b = a + s, b + first
        if same:
            a, b = a[a < b], b[a < b]
        yield a, b


def _near(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """The candidates with cosine >= ``threshold`` in double precision, in parts."""
    step = max(1, PART // max(1, x.shape[1]))
    for a, b in candidates(x, y, threshold, same):
        for k in range(0, len(a), step):
            i, j = a[k:k + step], b[k:k + step]
            keep = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
            yield i[keep], j[keep]


class Forest:
    """A spanning forest of the links seen so far, and the weight of each node's links."""

    def __init__(self, size: int):
        self.root = np.arange(size)
        self.weight = np.zeros(size, np.int64)
        self.edges: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def add(self, i: np.ndarray, j: np.ndarray, times: np.ndarray) -> None:
        np.add.at(self.weight, i, times[j])
        np.add.at(self.weight, j, times[i])
        new = self.root[i] != self.root[j]  # roots are flat between calls
        if not new.any():
            return
        for a, b in zip(i[new].tolist(), j[new].tolist()):
            x, y = self.find(a), self.find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.edges.append((a, b))
        while (self.root != self.root[self.root]).any():
            self.root = self.root[self.root]


def links(classes: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b, m) of the links with cosine >= ``threshold`` between the classes (node,
    vec, n): with b, an edge of a forest that connects what links connect; without, a
    part of the number of vectors (n) that node a links to, to be added up."""
    count, components = classes.agg(F.count("*"), F.sum(F.size("vec").cast("bigint"))).first()
    tiles = max(1, -(-count // tile_rows), -(-(components or 0) * 8 // TILE_BYTES))

    def pack(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        parts: dict[int, list] = {}
        for b in batches:
            node, vecs, n = b.column(0).to_numpy(), b.column(1), b.column(2).to_numpy()
            size = np.diff(vecs.offsets.to_numpy())
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                parts.setdefault(dim, []).append((node[at], n[at], vecs.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)))
        tile = TaskContext.get().partitionId()
        for dim, found in parts.items():
            vecs = np.concatenate([v for *_, v in found])
            with np.errstate(over="ignore"):
                short = vecs.astype(np.float32)
            vecs = short if (short == vecs).all() else vecs  # what came as floats travels as floats
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([tile], pa.int32()),
                 pa.array([np.concatenate([np.concatenate([c[k] for c in found]) for k in (0, 1)]).tobytes()], pa.binary()),
                 pa.array([vecs.tobytes()], pa.binary())], ["dim", "tile", "nodes", "vecs"])

    def compare(table):
        import pyarrow as pa
        dim = table.column("dim")[0].as_py()
        sides = sorted(zip(*(table.column(c).to_pylist() for c in ("tile", "nodes", "vecs"))), key=lambda r: r[0])
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        a, b, m = [], [], []
        if len(sides) == 2 or low == high:  # else the other tile has no vectors of this dimension
            read = []
            for _, about, raw in sides[:1] if low == high else sides:
                node, n = np.frombuffer(about, np.int64).reshape(2, -1)
                read.append((node, n, _unit(np.frombuffer(raw, np.float32 if len(raw) == 4 * dim * len(node) else np.float64)
                                            .reshape(-1, dim).astype(np.float64))))
            shift = 0 if low == high else len(read[0][0])
            node, n = (np.concatenate([r[k] for r in read]) for k in (0, 1))
            forest = Forest(len(node))
            for i, j in _near(read[0][2], read[-1][2], threshold, low == high):
                forest.add(i, j + shift, n)
            linked = np.flatnonzero(forest.weight)
            a = [node[i] for i, _ in forest.edges] + node[linked].tolist()
            b = [node[j] for _, j in forest.edges] + [None] * len(linked)
            m = [None] * len(forest.edges) + forest.weight[linked].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "m": pa.array(m, pa.int64())})

    # dealt in turn, not by a key: no tile grows with a common value
    packed = scratch(classes.select("node", "vec", "n").repartition(tiles)
                     .mapInArrow(pack, "dim int, tile int, nodes binary, vecs binary"), "tiles")
    met = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "dim", "tile", "nodes", "vecs")
    return met.groupBy("dim", "low", "high").applyInArrow(compare, "a bigint, b bigint, m bigint")


def embedding_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable, itself included), ``kept`` (it is that id)."""
    rows, classes = _classes(df, id_col, vec_col)
    found = scratch(links(classes, threshold), "links")
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("m").alias("linked"))
    comp = connected_components(found.where("b is not null"), "a", "b")
    rooted = classes.select("node", "n", "low").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    info = scratch(rooted.join(best, "root").join(degree, "node", "left")
                   .select("node", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id"), "nodes")
    alone = rows.where("node is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = alone.unionByName(rows.where("node is not null").join(info, "node").select("id", "n_links", "component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
