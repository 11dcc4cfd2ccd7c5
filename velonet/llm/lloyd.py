"""Centroid clustering by dual-tree Lloyd: a cover tree over the vectors, a tree over the centroids each round.

Vectors are whole numbers: floor(GRID * x) of each component. They are laid in blocks of BLOCK vectors that lie near each other, and
each block gets a cover tree: a node has one of its own vectors as centre, its radius reaches all below it, its children's centres
are more than the radius / BASE apart and reach all within that. Trees are built once and written; a round reads them.

A round builds such a tree over the centroids, and each block descends both trees at once. A pair of nodes is pruned once the least
distance it allows is above the greatest that another pair guarantees; where one centroid is left, the whole node below it goes
there; at leaves, distances are compared exactly, and the smaller centroid number wins a tie. Bounds are doubles with a margin, so
they only ever keep too much. A task sends one sum and count for each centroid; the driver holds k centroids.

Kept are vectors with exactly `dim` components, none null or not finite; all others aren't in the result. Defined cases: a
null vec_id is an id like any other, but comes last in the choice of first centroids; repeated rows and equal vectors count as
often as they occur; fewer vectors than k give as many centroids; a centroid without vectors stays where it is; other columns aren't
read. Components past 2 ** 27 in size after scaling would leave the range of long distances: they raise an error. Empty in,
empty out. Blocks are cut from the rows as they lie, so a hot vector, id or file makes no larger task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.operators.scratch import discard, written

DIM, GRID, K, ROUNDS, SEED = 64, 64, 16, 3, 1
BLOCK, BASE = 512, 1.3
#: Rows that a task orders at once, before it cuts them into blocks.
HELD = 1 << 13
#: Components up to this size have exact squares of distances as doubles, up to LARGEST as longs.
_EXACT, LARGEST = 1 << 22, 1 << 27


class Tree(NamedTuple):
    """Nodes by breadth. A node's points are order[start:end], its children nodes[low:high]; centre is a point."""

    order: np.ndarray
    centre: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    radius: np.ndarray

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of nodes, child) of all their children."""
        n = self.high[nodes] - self.low[nodes]
        which = np.repeat(np.arange(len(nodes)), n)
        return which, self.low[nodes][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b, exact."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) > _EXACT:
        return np.stack([((a - y) ** 2).sum(axis=1) for y in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    return ((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)).astype(np.int64)


def pair_squares(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of a[i] and b[j]: from the whole table where most of it is asked for."""
    ui, at_i = np.unique(i, return_inverse=True)
    uj, at_j = np.unique(j, return_inverse=True)
    if len(ui) * len(uj) <= 8 * len(i):
        return squares(a[ui], b[uj])[at_i, at_j]
    return np.concatenate([((a[i[s : s + 4096]] - b[j[s : s + 4096]]) ** 2).sum(axis=1) for s in range(0, len(i), 4096)])


def cover_tree(points: np.ndarray, base: float = BASE) -> Tree:
    """Of at most a block of points, one at least."""
    d = np.sqrt(squares(points, points).astype(np.float64))
    order = np.arange(len(points))
    root = int(np.argmin(d.max(axis=1)))
    nodes = [[root, 0, len(points), 0, 0, 0.0]]
    for at, node in enumerate(nodes):  # grows as it is read
        centre, start, end = node[:3]
        own = order[start:end].copy()
        to = d[centre, own]
        radius = node[5] = float(to.max())
        node[3] = node[4] = len(nodes)
        if radius == 0:
            continue
        # centres of children: the node's own, all that none is near to, and of the others one after the other
        rest = own[to > radius / base]
        near = d[np.ix_(rest, rest)] <= radius / base
        alone = near.sum(axis=1) == 1
        net, open_ = [centre, *rest[alone].tolist()], ~alone
        while open_.any():
            pick = int(np.argmax(open_))
            net.append(int(rest[pick]))
            open_ &= ~near[pick]
        child = d[np.ix_(net, own)].argmin(axis=0)
        by = np.argsort(child, kind="stable")
        order[start:end] = own[by]
        ends = start + np.cumsum(np.bincount(child, minlength=len(net)))
        nodes += [[c, int(s), int(e), 0, 0, 0.0] for c, s, e in zip(net, [start, *ends[:-1]], ends, strict=True)]
        node[4] = len(nodes)
    c, s, e, low, high = (np.array([n[k] for n in nodes], np.int32) for k in range(5))
    return Tree(order.astype(np.int32), c, s, e, low, high, np.array([n[5] for n in nodes]))


def _first(ids: np.ndarray) -> np.ndarray:
    """Where runs of equal ids begin."""
    return np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)


def assign(points: np.ndarray, tree: Tree, centroids: np.ndarray, over: Tree) -> np.ndarray:
    """The number of the nearest centroid of each point, by both trees; of equally near ones the smallest."""
    label = np.zeros(len(points), np.int32)
    least = np.minimum.reduceat(over.order, over.start) if len(over.start) == 1 else np.array([over.order[s:e].min() for s, e in zip(over.start, over.end, strict=True)])
    q, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(q):
        square = pair_squares(points, centroids, tree.centre[q], over.centre[c])
        d, first = np.sqrt(square.astype(np.float64)), _first(q)
        run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(q)]))
        bound = np.minimum.reduceat(d + tree.radius[q], first) * (1 + 1e-9) + 1e-6
        keep = d - tree.radius[q] - over.radius[c] <= bound[run]
        q, c, square = q[keep], c[keep], square[keep]
        first, closed = _first(q), over.radius[c] == 0
        size = np.diff(np.r_[first, len(q)])
        done = np.minimum.reduceat(closed, first) & ((size == 1) | (tree.radius[q[first]] == 0))
        if done.any():
            run = np.repeat(done, size)
            best = np.lexsort((least[c[run]], square[run], q[run]))
            best = best[_first(q[run][best])]
            for node, number in zip(q[run][best].tolist(), least[c[run][best]].tolist(), strict=True):
                label[tree.order[tree.start[node] : tree.end[node]]] = number
            q, c, closed = q[~run], c[~run], closed[~run]
        if not len(q):
            break
        # a pair opens its centroid node; once all of a node's are leaves, the node itself opens
        ready = np.repeat(np.minimum.reduceat(closed, _first(q)), np.diff(np.r_[_first(q), len(q)]))
        wide, stay = ~closed & ~ready, closed & ~ready
        i, child = over.children(c[wide])
        j, below = tree.children(q[ready])
        q, c = np.r_[q[stay], q[wide][i], below], np.r_[c[stay], child, c[ready][j]]
        by = np.argsort(q, kind="stable")
        q, c = q[by], c[by]
    return label


def whole(vectors: DataFrame, dim: int = DIM, grid: int = GRID) -> DataFrame:
    """(vec_id, v): the kept vectors, as whole numbers in doubles."""
    x = F.col("embedding").cast("array<double>")
    good = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).select("vec_id", F.transform("x", lambda v: F.floor(v * grid).cast("double")).alias("v"))


def first_centroids(kept: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the least SHA-256 of `seed:vec_id`, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").toArrow()
    return _matrix(rows["v"].combine_chunks()) if rows.num_rows else np.zeros((0, 0), np.int64)


def _matrix(v: pa.Array | pa.ChunkedArray) -> np.ndarray:
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    flat = v.flatten().to_numpy(zero_copy_only=False)
    if np.abs(flat).max(initial=0) > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST} after scaling: distances would leave the range of longs")
    return flat.astype(np.int64).reshape(len(v), -1)


_BLOCK = "ids array<long>, points binary, tree binary, radius binary, nodes int"


def _packed(ids: pa.Array, points: np.ndarray) -> dict:
    t = cover_tree(points)
    return {"ids": ids.to_pylist(), "points": points.astype("<i4").tobytes(), "tree": np.concatenate(t[:6]).astype("<i4").tobytes(), "radius": t.radius.astype("<f8").tobytes(), "nodes": len(t.centre)}


def _unpacked(row: dict) -> tuple[list, np.ndarray, Tree]:
    n, parts = len(row["ids"]), np.frombuffer(row["tree"], "<i4")
    points = np.frombuffer(row["points"], "<i4").reshape(n, -1).astype(np.int64)
    return row["ids"], points, Tree(parts[:n], *parts[n:].reshape(5, row["nodes"]), np.frombuffer(row["radius"], "<f8"))


def blocks(kept: DataFrame, pivots: np.ndarray, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """Blocks of vectors with their cover trees. Rows of a task are ordered by their nearest pivot and its distance first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("points", pa.binary()), ("tree", pa.binary()), ("radius", pa.binary()), ("nodes", pa.int32())])

        def cut(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(parts).combine_chunks()
            x = _matrix(t["v"])
            d = squares(x, pivots)
            near = d.argmin(axis=1)
            by = np.lexsort((d[np.arange(len(x)), near], near))
            ids = t["vec_id"].combine_chunks().take(pa.array(by))
            for s in range(0, len(by), block):
                yield pa.RecordBatch.from_pylist([_packed(ids[s : s + block], x[by[s : s + block]])], schema=schema)

        parts, rows = [], 0
        for b in batches:
            for s in range(0, b.num_rows, held):
                parts.append(b.slice(s, held))
                rows += parts[-1].num_rows
                if rows >= held:
                    yield from cut(parts)
                    parts, rows = [], 0
        if rows:
            yield from cut(parts)

    return kept.select("vec_id", "v").mapInArrow(run, _BLOCK)


def _assigned(table: DataFrame, centroids: np.ndarray, final: bool) -> DataFrame:
    """A row for each vector (vec_id, cluster, distance), or one a task for each cluster (cluster, n, sums)."""
    shared = table.sparkSession.sparkContext.broadcast((centroids, cover_tree(centroids)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        c, over = shared.value
        for b in batches:
            for s in range(b.num_rows):
                ids, points, tree = _unpacked(b.slice(s, 1).to_pylist()[0])
                yield ids, points, assign(points, tree, c, over)

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, points, label in each(batches):
            d = ((points - shared.value[0][label]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(label), pa.array(d)], names=["vec_id", "cluster", "distance"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = shared.value[0].shape
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, points, label in each(batches):
            by = np.argsort(label, kind="stable")
            first = _first(label[by])
            total[label[by][first]] += np.add.reduceat(points[by], first, axis=0)
            n += np.bincount(label, minlength=k)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    if final:
        return table.mapInArrow(distances, "vec_id long, cluster int, distance long")
    return table.mapInArrow(sums, "cluster int, n long, sums array<long>")


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means of their vectors; those without vectors stay."""
    rows = _assigned(table, centroids, False).select("cluster", "n", F.posexplode("sums").alias("at", "x"))
    out = centroids.copy()
    for r in rows.groupBy("cluster", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect():  # k * dim rows
        out[r["cluster"], r["at"]] = r["x"] // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, grid: int = GRID, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    kept = whole(vectors, dim, grid)
    centroids = first_centroids(kept, k, seed)
    named = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id long, cluster int, distance long, {named.split(', ', 1)[1]}")
    table = written(blocks(kept, centroids), "blocks")
    for _ in range(rounds):
        centroids = moved(table, centroids)
    out = written(_assigned(table, centroids, True), "assigned")
    discard(table)
    sums = {r["cluster"]: r["d"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    rows = [(c, d, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in sums.items()]
    return out.join(F.broadcast(spark.createDataFrame(rows, named)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
