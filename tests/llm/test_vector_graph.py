"""Embedding near-duplicates against comparison of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from velonet.llm import vector_graph
from velonet.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node long, x string, shard int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, label, 1, "x", 2, 3) for i, e, label in rows], SCHEMA).repartition(3)


def plain(rows, least=vector_graph.LEAST):
    """(vec_id, n_links, component_id, kept) of each row."""
    good = [n for n, (_, e, label) in enumerate(rows) if label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links = {n: set() for n in range(len(rows))}
    for k in {(rows[n][2], len(rows[n][1])) for n in good}:
        own = [n for n in good if (rows[n][2], len(rows[n][1])) == k]
        x = np.array([rows[n][1] for n in own], np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= least), strict=True):
            if a != b:
                links[own[a]].add(own[b])
    out = []
    for n, (i, _, _) in enumerate(rows):
        seen, ring = {n}, [n]
        while ring:
            ring = [m for r in ring for m in links[r] if m not in seen and not seen.add(m)]
        c = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((i, len(links[n]), c, i == c))
    return out


def run(spark, rows, **kw):
    return [tuple(r) for r in vector_graph.near_duplicates(frame(spark, rows), **kw).collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def groups(rng, n, dim, noise, labels=3):
    """Vectors about a few centres, so that chains and dense groups of links occur; some are copies."""
    middle = rng.normal(size=(n // 8, dim))
    x = middle[rng.integers(0, len(middle), n)] + rng.normal(size=(n, dim)) * noise
    x[rng.integers(0, n, n // 10)] = x[rng.integers(0, n, n // 10)]
    return [(int(i), v.tolist(), int(i) % labels) for i, v in zip(rng.permutation(n), x.astype(np.float32), strict=True)]


@pytest.mark.parametrize("seed", range(2))
def test_as_all_pairs(spark, seed):
    rows = groups(np.random.default_rng(seed), 400, 8, 0.25)
    rows += rows[:20]
    assert key(run(spark, rows)) == key(plain(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0] * 3, 1), (4, [1.0, None, 1.0], 1), (5, [nan, 1.0, 1.0], 1), (6, [inf, 1.0, 1.0], 1), (7, one, None), (8, one, None)]
    rows += [(9, one, 1), (9, one, 1), (10, [2.0, 4.0, 6.0], 1), (11, one, 2), (None, one, 2), (None, [9.0, -1.0, 0.0], 3), (12, [1.0, 2.0], 1), (13, [1.0, 2.0], 1), (14, [3e38, 6e38 / 2, 0.0], 4), (15, [1e-38, 1e-38, 0.0], 4)]
    assert key(run(spark, rows)) == key(plain(rows))
    assert run(spark, []) == []


def test_shards_and_parts(spark, monkeypatch):
    """Labels past a unit's rows: overlapping shards, and a dense group that only parts can hold."""
    monkeypatch.setattr(vector_graph, "CAP", 100)
    monkeypatch.setattr(vector_graph, "SHARD", 50)
    rng = np.random.default_rng(5)
    rows = groups(rng, 500, 16, 0.1, labels=1)
    hot = rng.normal(size=16)
    rows += [(1000 + i, (hot + rng.normal(size=16) * 0.05).tolist(), 0) for i in range(300)]
    got, want = {r[0]: r for r in run(spark, rows)}, {r[0]: r for r in plain(rows)}
    assert got.keys() == want.keys() and all(got[i][1] <= want[i][1] for i in got)
    assert sum(r[1] for r in got.values()) >= 0.95 * sum(r[1] for r in want.values())
    assert all(got[1000 + i][1] == want[1000 + i][1] for i in range(300))  # parts lose nothing
    assert np.mean([got[i][2] == want[i][2] for i in got]) > 0.95


def test_audit_and_wider_search(spark, monkeypatch):
    rows = vector_graph.valid(frame(spark, groups(np.random.default_rng(2), 300, 8, 0.2))).where("node is not null")
    true = {r["node"]: r["n"] for r in vector_graph.links(rows, 0.93, 2, 8).groupBy("node").agg(F.sum("n").alias("n")).collect()}
    named = rows.groupBy("node").agg(F.count("*").alias("copies"))
    count = lambda f: named.withColumn("n_links", F.col("copies") - 1 + F.coalesce(F.create_map(*[F.lit(x) for kv in true.items() for x in kv])[F.col("node")], F.lit(0)) * f)
    assert vector_graph.audit(rows, count(1)) == 1.0 and vector_graph.audit(rows, count(0)) < 0.7
    asked, links = [], vector_graph.links
    monkeypatch.setattr(vector_graph, "links", lambda r, least, overlap, beam: asked.append((overlap, beam)) or (links(r, least, overlap, beam).where(F.lit(overlap > 2))))
    some = groups(np.random.default_rng(3), 200, 8, 0.2)
    assert key(run(spark, some)) == key(plain(some)) and asked == [(2, 8), (4, 16)]


@pytest.mark.parametrize("dim", [4, 32])
def test_search_meets_its_query_and_all_in_range(dim):
    rng = np.random.default_rng(dim)
    u = vector_graph.unit_vectors(np.r_[rng.normal(size=(900, dim)), rng.normal(size=dim) + rng.normal(size=(124, dim)) * 0.05])
    begin, next_to, medoids = graph = vector_graph.flat_graph(u)
    assert len(begin) == 1025 and len(medoids) > 1 and len(next_to) < 1024 * 4 * vector_graph.DEGREE
    q, node = vector_graph.search(u, graph, np.arange(1024), 0.93, vector_graph.BEAM)
    got = set(zip(q.tolist(), node.tolist(), strict=True))
    want = set(zip(*(x.tolist() for x in np.nonzero(u @ u.T >= 0.93)), strict=True))
    assert got <= want and {(i, i) for i in range(1024)} <= got and len(got) >= 0.97 * len(want)


def test_robust_prune():
    """A kept neighbour hides what it is much nearer to than the member; the nearest is always kept."""
    u = vector_graph.unit_vectors(np.random.default_rng(1).normal(size=(60, 6)))
    a, b, _ = vector_graph._pruned(u)
    d = np.sqrt(np.maximum(0, 2 - 2 * u @ u.T))
    for n in range(60):
        own = b[a == n]
        assert own[0] == np.argsort(d[n])[1] and len(set(own.tolist())) == len(own) <= vector_graph.DEGREE
        assert all(vector_graph.ALPHA * d[own[i], own[j]] > d[n, own[j]] for j in range(len(own)) for i in range(j))


def test_many_centres_by_their_groups():
    rng = np.random.default_rng(0)
    c, u = (vector_graph.unit_vectors(rng.normal(size=(n, 8))) for n in (900, 500))
    got = vector_graph._nearest(u, c, 2)
    assert got.min() >= 0 and (got == (u @ c.T).argmax(axis=1)[:, None]).any(axis=1).mean() > 0.8


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert key(tuple(r) for r in QUERIES["op12_embedding_near_dedup"](spark, sf).collect()) == key(plain(rows))
