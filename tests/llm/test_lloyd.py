"""Dual-tree Lloyd against plain whole-number arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from velonet.llm import lloyd
from velonet.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, n long, v string, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, 3, "v", "i") for i, e in rows], SCHEMA).repartition(3)


def plain(rows, k, rounds, dim):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [q for _, q in sorted(kept, key=key)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda: [min((square(q, c), n) for n, c in enumerate(centroids)) for _, q in kept]
    for _ in range(rounds):
        at = place()
        for n in range(len(centroids)):
            own = [q for (_, q), (_, m) in zip(kept, at, strict=True) if m == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = place() if centroids else []
    sums = {n: sum(d for d, m in at if m == n) for n in range(len(centroids))}
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((-1 if i is None else i, n, d, sums[n], sum(sums.values()), sha(centroids[n])) for (i, _), (d, n) in zip(kept, at, strict=True))


def run(spark, rows, k=5, rounds=3, dim=4):
    got = lloyd.cluster(frame(spark, rows), k, rounds, dim).collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_as_plain(spark, seed):
    """A third of the vectors are one, the others lie on a coarse grid, so that very many distances tie."""
    r = random.Random(seed)
    rows = [(i, [0.5] * 4 if r.random() < 0.3 else [r.randint(-2, 2) / 4 for _ in range(4)]) for i in range(400)]
    assert run(spark, rows) == plain(rows, 5, 3, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, 2.0, None, 1.0]), (5, [nan] * 4), (6, [inf, 0.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0, -inf])]
    good = [(8, [1.0, 2.0, 3.0, 4.0]), (8, [1.0, 2.0, 3.0, 4.0]), (8, [-1.0, 0.0, 0.0, 0.0]), (None, [0.1] * 4), (9, [-0.0] * 4)]
    assert run(spark, rows + good) == plain(good, 5, 3, 4)
    assert run(spark, rows) == []


def test_empty(spark):
    got = lloyd.cluster(frame(spark, []))
    assert got.isEmpty() and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components(spark):
    rows = [(i, [float(x * 2**19), -float(x * 2**20), 1.0, float(i)]) for i, x in enumerate([1, 2, 1, 2, 0, 2, 1, 2])]
    assert run(spark, rows, 2) == plain(rows, 2, 3, 4)
    with pytest.raises(Exception, match="larger than"):
        run(spark, [(1, [1e9, 0.0, 0.0, 0.0])])


@pytest.mark.parametrize("seed", range(4))
def test_tree_invariants_and_assignment(seed):
    rng = np.random.default_rng(seed)
    middle = rng.integers(-40, 40, (6, 8))
    points = (middle[rng.integers(0, 6, 300)] + rng.integers(-3, 4, (300, 8)))[:, : 2 + 2 * seed]
    tree = lloyd.cover_tree(points)
    d = np.sqrt(lloyd.squares(points, points).astype(float))
    assert sorted(tree.order.tolist()) == list(range(300))
    for n, (c, s, e, low, high) in enumerate(zip(tree.centre, tree.start, tree.end, tree.low, tree.high, strict=True)):
        own = tree.order[s:e]
        assert c in own and d[c, own].max() <= tree.radius[n]
        if tree.radius[n] > 0:
            assert tree.start[low] == s and tree.end[high - 1] == e and (tree.start[low + 1 : high] == tree.end[low : high - 1]).all()
            child = tree.centre[low:high]
            between = d[np.ix_(child, child)] + np.diag([np.inf] * len(child))
            assert between.min() > tree.radius[n] / lloyd.BASE and tree.radius[low:high].max() <= tree.radius[n] / lloyd.BASE
    centroids = points[rng.integers(0, 300, 20)]  # some of them equal
    want = lloyd.squares(points, centroids).argmin(axis=1)
    assert (lloyd.assign(points, tree, centroids, lloyd.cover_tree(centroids)) == want).all()


def test_pruning_leaves_most_pairs_out(monkeypatch):
    """Well parted groups: whole nodes go to their centroid."""
    rng = np.random.default_rng(1)
    middle = rng.integers(-4000, 4000, (16, 8))
    points = middle[np.arange(512) % 16] + rng.integers(-3, 4, (512, 8))
    asked, pair_squares = [], lloyd.pair_squares
    monkeypatch.setattr(lloyd, "pair_squares", lambda a, b, i, j: asked.append(len(i)) or pair_squares(a, b, i, j))
    label = lloyd.assign(points, lloyd.cover_tree(points), middle, lloyd.cover_tree(middle))
    assert (label == np.arange(512) % 16).all() and sum(asked) < 512 * 16 / 4


def test_query_matches_sql(spark):
    import duckdb

    from velonet.llm.queries import SQL

    sf, con, name = "/root/testdata/sf0.001", duckdb.connect(), "op11_centroid_clustering"
    con.sql(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    key = lambda t: sorted(tuple(str(r[c]) for c in sorted(t.schema.names)) for r in t.to_pylist())
    assert key(QUERIES[name](spark, sf).toArrow()) == key(con.sql(SQL[name]).to_arrow_table())
