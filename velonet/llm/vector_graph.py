"""Embedding near-duplicates by robust-pruned flat graphs: links of cosine LEAST or more between vectors of one label.

Equal vectors of a label are one node, named by a 64-bit hash; tasks sum copies before they send them. A label with more than CAP
rows is dealt over shards by centres from a bounded sample, no two of which lie within NET of each other; a node goes to its OVERLAP
nearest. A shard that still has more than CAP rows (a dense group around one centre) is cut into parts, and every two parts meet in
a unit of their own: the exact way for what a cap would lose. So a unit holds CAP rows or so, whatever the input; a shard of p parts sends each
row p times, and compares as many pairs as such a group has links, but no pair leaves a unit.

In a unit, nodes lie in overlapping clusters. Each cluster gives its members' nearest candidates, pruned robustly (a candidate goes if a
kept one is ALPHA times nearer to it than the member); the lists of all clusters are united, with their reverse. Each node then is a
query: a greedy search from the clusters' medoids, whose beam widens until the query has met itself, and from all that is in range the search
expands to their neighbours while these are in range too. Cosines are computed in doubles from the vectors as given: none below the bound
is a link. What a unit gives is a count and one edge of a spanning forest a node. A pair that meets in several shards counts in the first.

Recall is audited in every run: AUDIT vectors, chosen by hash, against all rows in blocks. Below WANTED the search is repeated
with twice the overlap and the beam, and its last result stands; audit() gives the figure.

Defined cases: a vector that is null, empty, zero, or holds null or not finite components links with nothing, nor does one without a
label; nor vectors of different length. Each row of the input gives one row: repeated rows count as others. A null vec_id is never
a component's id unless no member has one. Ties need no order. Other columns aren't read. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.operators.graph import least_reachable
from velonet.operators.scratch import discard, written

LEAST = 0.93
#: Rows of a shard as meant, and at most of a unit; centres that a node goes to; the bound on all centres (256 bytes each, broadcast).
SHARD, CAP, OVERLAP, MOST_CENTRES = 2048, 4096, 2, 1 << 16
#: Centres are no closer than this cosine.
NET = 0.6
#: Members of a cluster, candidates of a member, neighbours kept, the prune's factor, the first beam.
CLUSTER, CANDIDATES, DEGREE, ALPHA, BEAM = 256, 24, 8, 1.2, 8
AUDIT, WANTED = 512, 0.95
#: Rows whose copies a task sums before it sends them, and queries that a unit searches at once.
HELD, QUERIES = 1 << 15, 512


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _ragged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, at): all places of the ranges low to high."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return which, low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def _clusters(u: np.ndarray) -> list[np.ndarray]:
    """Overlapping clusters: each row in those of its two nearest centres; large ones in slices that overlap by half."""
    n = len(u)
    if n <= CLUSTER:
        return [np.arange(n)]
    m = -(-2 * n // CLUSTER)
    centre = np.linspace(0, n - 1, m).astype(int)
    s = u @ u[centre].T
    two = np.argpartition(-s, 1, axis=1)[:, :2]
    row, to = np.repeat(np.arange(n), 2), two.ravel()
    by = np.lexsort((-s[row, to], to))
    row, to = row[by], to[by]
    out = []
    for own in np.split(row, np.flatnonzero(to[1:] != to[:-1]) + 1):
        out += [own[k : k + 2 * CLUSTER] for k in range(0, max(1, len(own) - CLUSTER), CLUSTER)]
    return out


def _pruned(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(from, to) of a cluster's robust-pruned lists, and its medoid."""
    n = len(u)
    s = u @ u.T
    medoid = int(np.argmax(s.sum(axis=1)))
    if n < 2:
        return np.zeros(0, int), np.zeros(0, int), medoid
    d = np.sqrt(np.maximum(0, 2 - 2 * s))
    np.fill_diagonal(d, np.inf)
    k, row = min(CANDIDATES, n - 1), np.arange(n)
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, axis=1), axis=1, kind="stable"), axis=1)
    own, alive, a, b = np.take_along_axis(d, near, axis=1), np.ones((n, k), bool), [], []
    for _ in range(min(DEGREE, k)):
        first = alive.argmax(axis=1)
        has = alive[row, first]
        to = near[row, first]
        a.append(row[has])
        b.append(to[has])
        alive[row, first] = False
        alive &= ALPHA * d[to[:, None], near] > own
    return np.concatenate(a), np.concatenate(b), medoid


def flat_graph(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, neighbours, medoids): the united lists of all clusters, both ways; those of i are neighbours[begin[i]:begin[i + 1]]."""
    n, a, b, medoids = len(u), [], [], []
    for own in _clusters(u):
        x, y, m = _pruned(u[own])
        a.append(own[x])
        b.append(own[y])
        medoids.append(own[m])
    a, b = np.concatenate(a), np.concatenate(b)
    pair = np.unique(np.r_[a * n + b, b * n + a])
    return np.searchsorted(pair // n, np.arange(n + 1)), pair % n, np.unique(medoids)


def _dots(u: np.ndarray, q: np.ndarray, i: np.ndarray) -> np.ndarray:
    return np.concatenate([np.einsum("ij,ij->i", u[q[s : s + 8192]], u[i[s : s + 8192]]) for s in range(0, len(q), 8192)]) if len(q) else np.zeros(0)


def _expand(u: np.ndarray, graph: tuple, query: np.ndarray, seen: np.ndarray, q: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of query, neighbour, cosine) of all neighbours of the pairs that their queries haven't seen yet."""
    begin, next_to, _ = graph
    which, at = _ragged(begin[node], begin[node + 1])
    pair = q[which] * seen.shape[1] + next_to[at]
    pair = np.unique(pair[~seen.ravel()[pair]])
    seen.ravel()[pair] = True
    q, node = pair // seen.shape[1], pair % seen.shape[1]
    return q, node, _dots(u, query[q], node)


def search(u: np.ndarray, graph: tuple, query: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs in range, of the nodes `query`."""
    n, medoids = len(u), graph[2]
    hit_q, hit_node, left, width = [], [], np.arange(len(query)), beam
    while len(left):
        seen = np.zeros((len(left), n), bool)
        own = query[left]
        s = u[own] @ u[medoids].T
        k = min(max(1, width // 3), len(medoids))
        start = np.argpartition(-s, k - 1, axis=1)[:, :k]
        ids = np.full((len(left), width), -1)
        cos = np.full((len(left), width), -2.0)
        ids[:, :k], cos[:, :k] = medoids[start], np.take_along_axis(s, start, axis=1)
        row = np.repeat(np.arange(len(left)), k)
        if width > 8 * beam:  # the graph doesn't lead there
            ids[:, -1], cos[:, -1] = own, 1.0
        live = ids >= 0
        seen[np.nonzero(live)[0], ids[live]] = True
        opened = ~live
        found = [(np.nonzero(live)[0], ids[live], cos[live])]
        while True:
            row = np.flatnonzero(~opened.all(axis=1))
            if not len(row):
                break
            best = np.where(opened[row], -3.0, cos[row]).argmax(axis=1)
            opened[row, best] = True
            q, node, c = _expand(u, graph, own, seen, row, ids[row, best])
            if not len(q):
                continue
            found.append((q, node, c))
            by = np.lexsort((-c, q))
            q, node, c = q[by], node[by], c[by]
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            at = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
            few = at < width
            q, node, c, at = q[few], node[few], c[few], at[few]
            rows = q[at == 0]
            place, wide = np.searchsorted(rows, q), int(at.max()) + 1
            more_ids, more_cos, more_open = np.full((len(rows), wide), -1), np.full((len(rows), wide), -2.0), np.ones((len(rows), wide), bool)
            more_ids[place, at], more_cos[place, at], more_open[place, at] = node, c, False
            all_ids, all_cos, all_open = np.hstack([ids[rows], more_ids]), np.hstack([cos[rows], more_cos]), np.hstack([opened[rows], more_open])
            top = np.argpartition(-all_cos, width - 1, axis=1)[:, :width]
            ids[rows], cos[rows], opened[rows] = (np.take_along_axis(x, top, axis=1) for x in (all_ids, all_cos, all_open))
        met = seen[np.arange(len(left)), own]
        q, node, c = (np.concatenate(x) for x in zip(*found, strict=True))
        near = (c >= least) & met[q]
        q, node = q[near], node[near]
        while len(q):
            hit_q.append(own[q])
            hit_node.append(node)
            q, node, c = _expand(u, graph, own, seen, q, node)
            q, node = q[c >= least], node[c >= least]
        left, width = left[~met], 4 * width
    return (np.concatenate(hit_q), np.concatenate(hit_node)) if hit_q else (np.zeros(0, int), np.zeros(0, int))


def _spanning(found: np.ndarray) -> np.ndarray:
    """For each row of the symmetric table its component's first row."""
    label, first = np.full(len(found), -1), found.any(axis=1)
    label[~first] = np.flatnonzero(~first)
    for r in np.flatnonzero(first):
        if label[r] >= 0:
            continue
        ring = np.array([r])
        while len(ring):
            label[ring] = r
            ring = np.flatnonzero(found[ring].any(axis=0) & (label < 0))
    return label


def unit_links(table: pa.Table, least: float, beam: int) -> pa.Table:
    """(node, at, n) of a unit's linked nodes: one node of its component, the linked vectors to count here."""
    node = table["node"].to_numpy()
    _, first, place = np.unique(node, return_index=True, return_inverse=True)
    node, weight = node[first], np.bincount(place, table["copies"].to_numpy().astype(float)).astype(np.int64)
    others = table["others"].combine_chunks()
    part, shard = table["part"].to_numpy()[first], table["shard"][0].as_py()
    x = table["x"].combine_chunks().take(pa.array(first))
    u = unit_vectors(x.flatten().to_numpy(zero_copy_only=False).reshape(len(first), -1))
    n, graph = len(u), flat_graph(u)
    found = np.zeros((n, n), bool)
    for s in range(0, n, QUERIES):
        found[search(u, graph, np.arange(s, min(n, s + QUERIES)), least, beam)] = True
    found |= found.T
    np.fill_diagonal(found, False)
    linked = np.flatnonzero(found.any(axis=1))
    found = found[np.ix_(linked, linked)]
    at, one, earlier = _spanning(found), part[linked], {}
    if table["a"][0].as_py() != table["b"][0].as_py():  # pairs within a part count where it meets itself
        found &= one[:, None] != one
    for k, own in enumerate(others.take(pa.array(first[linked])).to_pylist()):
        for o in own:
            if o < shard:  # pairs that meet in an earlier shard too count there
                earlier.setdefault(o, []).append(k)
    for own in earlier.values():
        found[np.ix_(own, own)] = False
    counts = np.array([int(weight[linked][r].sum()) for r in found], np.int64)
    return pa.table([pa.array(node[linked], pa.int64()), pa.array(node[linked][at], pa.int64()), pa.array(counts, pa.int64())], names=["node", "at", "n"])


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, label, dim, x): node is null where a vector links with nothing."""
    x = F.col("embedding")
    good = F.col("label").isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    label = F.col("label").cast("string")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.xxhash64(label, F.size(x), x)).alias("node"), label.alias("label"), F.size(x).alias("dim"), x.alias("x"))


def centres(rows: DataFrame, overlap: int) -> dict[tuple[str, int], np.ndarray]:
    """Unit vectors of centres for each label with more than CAP rows: a net over a sample by hash, bounded in all."""
    spark = rows.sparkSession
    large = rows.groupBy("label", "dim").count().where(F.col("count") > CAP).collect()  # rows / CAP at most
    wanted = {(r["label"], r["dim"]): -(-overlap * r["count"] // SHARD) for r in large}
    share = min(1.0, MOST_CENTRES / max(1, sum(wanted.values())))
    few = [(*k, int(2**31 * min(1.0, 3 * max(1, n * share) / next(r["count"] for r in large if (r["label"], r["dim"]) == k)))) for k, n in wanted.items()]
    if not few:
        return {}
    sample = rows.join(F.broadcast(spark.createDataFrame(few, "label string, dim int, below long")), ["label", "dim"]).where(F.pmod(F.xxhash64(F.lit("centre"), "node"), F.lit(2**31)) < F.col("below"))
    got = sample.groupBy("label", "dim", "node").agg(F.any_value("x").alias("x")).orderBy(F.xxhash64("node")).toArrow()
    out: dict[tuple[str, int], list] = {}
    for k, n in wanted.items():
        own = got.filter(pa.compute.and_(pa.compute.equal(got["label"], k[0]), pa.compute.equal(got["dim"], k[1])))
        if not own.num_rows:
            continue
        u = unit_vectors(own["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, k[1]))
        net = [0]
        for i in range(1, len(u)):
            if len(net) >= max(1, int(n * share)):
                break
            if (u[net] @ u[i]).max() < NET:
                net.append(i)
        out[k] = u[net].astype(np.float32)
    return out


def _nearest(u: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of the centres, through their own groups where there are many."""
    k = min(k, len(c))
    if len(c) <= 512:
        return np.argpartition(-(u @ c.T), k - 1, axis=1)[:, :k]
    top = c[:: int(len(c) ** 0.5)]
    group = (c @ top.T).argmax(axis=1)
    t = min(3, len(top))
    tops = np.argpartition(-(u @ top.T), t - 1, axis=1)[:, :t]
    cos, ids = np.full((len(u), k), -2.0), np.full((len(u), k), -1)
    for g in range(len(top)):
        row, own = np.flatnonzero((tops == g).any(axis=1)), np.flatnonzero(group == g)
        if len(row) and len(own):
            both = np.hstack([cos[row], u[row] @ c[own].T])
            names = np.hstack([ids[row], np.broadcast_to(own, (len(row), len(own)))])
            best = np.argpartition(-both, k - 1, axis=1)[:, :k]
            cos[row], ids[row] = np.take_along_axis(both, best, axis=1), np.take_along_axis(names, best, axis=1)
    return ids


def routed(rows: DataFrame, of: dict[tuple[str, int], np.ndarray], overlap: int) -> DataFrame:
    """(label, dim, node, copies, x, shards): distinct vectors of up to HELD rows, with their copies there."""
    shared = rows.sparkSession.sparkContext.broadcast(of)
    kind = dict(rows.dtypes)["x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(parts)
            _, first, copies = np.unique(t["node"].to_numpy(), return_index=True, return_counts=True)
            t = t.take(pa.array(first)).append_column("copies", pa.array(copies, pa.int64()))
            label, dim, shards = t["label"].to_numpy(zero_copy_only=False), t["dim"].to_numpy(), np.full(len(first), None)
            for k in {*zip(label.tolist(), dim.tolist(), strict=True)}:
                own = np.flatnonzero((label == k[0]) & (dim == k[1]))
                to = [[0]] * len(own)
                if k in shared.value:
                    x = t["x"].combine_chunks().take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
                    to = np.sort(_nearest(unit_vectors(x).astype(np.float32), shared.value[k], overlap), axis=1).tolist()
                shards[own] = np.fromiter(to, object, len(own))
            t = t.append_column("shards", pa.array(list(shards), pa.list_(pa.int32())))
            yield from t.select(["label", "dim", "node", "copies", "x", "shards"]).combine_chunks().to_batches()

        parts, n = [], 0
        for b in batches:
            parts.append(b)
            n += b.num_rows
            if n >= HELD:
                yield from flush(parts)
                parts, n = [], 0
        if n:
            yield from flush(parts)

    return rows.select("label", "dim", "node", "x").mapInArrow(run, f"label string, dim int, node long, copies long, x {kind}, shards array<int>")


def links(rows: DataFrame, least: float, overlap: int, beam: int) -> DataFrame:
    """(node, at, n) of unit_links() of all units."""
    of = centres(rows, overlap)
    sent = routed(rows, of, overlap)
    one = sent.withColumn("shard", F.explode("shards"))
    # only where a label is large can a shard be; a unit has the rows of two parts
    parts = one.groupBy("label", "dim", "shard").agg(F.count("*").alias("n")).where(F.col("n") > CAP).select("label", "dim", "shard", F.ceil(F.col("n") * 2 / CAP).cast("int").alias("parts"))
    dense = written(parts, "dense")
    one = one.join(dense, ["label", "dim", "shard"], "left") if not dense.isEmpty() else one.withColumn("parts", F.lit(1))
    one = one.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    unit = one.select("label", "dim", "shard", F.least("part", "to").alias("a"), F.greatest("part", "to").alias("b"), "part", "node", "copies", "x", F.array_remove("shards", F.col("shard")).alias("others"))
    return unit.groupBy("label", "dim", "shard", "a", "b").applyInArrow(lambda t: unit_links(t, least, beam), "node long, at long, n long")


def exact_counts(rows: DataFrame, of: pa.Table, least: float) -> DataFrame:
    """(node, links): the vectors that each of the vectors `of` (label, dim, node, x) links with, by comparison with all rows."""
    by_label: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    for k in {*zip(of["label"].to_pylist(), of["dim"].to_pylist(), strict=True)}:
        own = of.filter(pa.compute.and_(pa.compute.equal(of["label"], k[0]), pa.compute.equal(of["dim"], k[1])))
        by_label[k] = own["node"].to_numpy(), unit_vectors(own["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, -1))
    shared = rows.sparkSession.sparkContext.broadcast(by_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            label, dim = b["label"].to_numpy(zero_copy_only=False), b["dim"].to_numpy()
            for k, (node, u) in shared.value.items():
                own = np.flatnonzero((label == k[0]) & (dim == k[1]))
                for s in range(0, len(own), 4096):
                    at = own[s : s + 4096]
                    x = unit_vectors(b["x"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1))
                    for m, c in zip(node.tolist(), ((x @ u.T) >= least).sum(axis=0).tolist(), strict=True):
                        total[m] = total.get(m, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["node", "n"])

    # the vector itself is one of them
    return rows.select("label", "dim", "x").mapInArrow(run, "node long, n long").groupBy("node").agg((F.sum("n") - 1).alias("links"))


def audit(rows: DataFrame, found: DataFrame, least: float = LEAST, queries: int = AUDIT) -> float:
    """Recall of found (node, n_links) for the vectors with the least hashes, `queries` at most, by links and by vectors with links:
    the lesser of both. rows: of valid()."""
    some = rows.groupBy("label", "dim", "node").agg(F.any_value("x").alias("x")).orderBy(F.xxhash64(F.lit("audit"), "node")).limit(queries).toArrow()
    if not some.num_rows:
        return 1.0
    true = exact_counts(rows, some, least)
    got = true.join(found, "node", "left").where("links > 0").select("links", F.least(F.coalesce("n_links", F.lit(0)), "links").alias("got"))
    sums = got.agg(F.sum("got"), F.sum("links"), F.avg(F.col("got") / F.col("links"))).first()
    return min(sums[0] / sums[1], sums[2]) if sums[1] else 1.0


def near_duplicates(vectors: DataFrame, least: float = LEAST, overlap: int = OVERLAP, beam: int = BEAM, wanted: float = WANTED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding, label)."""
    every = valid(vectors)
    rows = every.where("node is not null")
    named = written(rows.groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("id")), "nodes")
    while True:
        found = written(links(rows, least, overlap, beam), "links")
        sums = found.groupBy("node").agg(F.sum("n").alias("n"))
        counted = written(named.join(sums, "node", "left").select("node", "id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "counted")
        if overlap >= 16 or audit(rows, counted, least) >= wanted:
            break
        discard(found)
        discard(counted)
        overlap, beam = 2 * overlap, 2 * beam
    label = least_reachable(found.select(F.col("node").alias("a"), F.col("at").alias("b"))).withColumnRenamed("id", "node")
    joined = written(counted.join(label, "node", "left").select("node", "id", "n_links", F.coalesce("component", "node").alias("component")), "joined")
    least_id = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    # written, so that the join below reads both sides as they come and may split a vector that very many rows share
    out = written(joined.join(least_id, "component").select("node", "n_links", "component_id"), "labels")
    done = every.select("vec_id", "node").join(out, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
