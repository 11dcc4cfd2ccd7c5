"""Near-duplicates by the words they share: one document stays of each group that links of similarity LEAST or more join.

Similarity is the Jaccard index of the sets of five-word shingles (words as in simhash; a text with fewer words, but some, is
one shingle; texts without words are alike). At 0.8 SimHash fingerprints lie up to a dozen bits apart, and no choice of blocks
finds these without comparing a constant share of all pairs. So the index of simhash gives its pairs within LIMIT bits, and
least hashes give the others: BANDS bands of ROWS least hashes, equal in one band at least for all but (1 - 0.8 ** ROWS) **
BANDS = 3e-6 of the pairs with similarity 0.8, and fewer above. Every pair is verified on the whole shingle sets.

A bucket of at most SMALL texts gives all its pairs; in a larger one each text meets the bucket's least first. Each text's pair with
its least candidate is verified first; of the other pairs only those whose ends are still apart. Large buckets whose texts are still apart
then are compared whole, the exact way for what pairs with the least leave out: a unit holds their shingle sets, counts what texts of different
components share by one matrix product, and gives an edge for components that it joins, never its pairs. A bucket past a unit's size is
cut into parts by text: each part of all texts meets each part of those outside the bucket's largest component. So a group of copies with a
few stragglers is sent about once, and a crowd of texts that lie about the bound, joined by no link, costs the comparisons that it has
pairs, spread over tasks. Pairs whose sizes alone keep them under LEAST are left out.

Defined cases: texts that are equal as bytes are one node; repeated rows and null ids are rows like any other, and one row stays
of each group: the one with the least id (null after all), then the least hash of its text. Very long texts are hashed whole; a unit
with one holds few others. Only doc_id and text are read, whatever the other columns' names. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.llm import simhash
from velonet.llm.common import by_size, keep_first, text_node
from velonet.operators.graph import least_reachable
from velonet.operators.scratch import discard, written

SHINGLE, LEAST, BANDS, ROWS = 5, 0.8, 24, 4
SMALL = 64
#: Texts, and shingles of all, that a unit of two parts holds.
UNIT_TEXTS, UNIT_SHINGLES = 2048, 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """The set, as sorted hashes: those of the words, mixed in their order."""
    w = text.lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = min(n, len(w))
    s = np.zeros(len(w) - n + 1 if n else 0, np.uint64)
    for k in range(n):
        s = (s ^ h[k : k + len(s)]) * _MIX
        s ^= s >> np.uint64(32)
    s.sort()
    new = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]


def band_keys(s: np.ndarray) -> np.ndarray:
    """A signed long for each band of least hashes."""
    low = np.full(len(_FACTORS), (1 << 64) - 1, np.uint64)
    for at in range(0, len(s), 4096):
        low = np.minimum(low, (s[at : at + 4096, None] * _FACTORS).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(b.tobytes()) for b in low.reshape(BANDS, ROWS)], np.uint64).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_node().alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """(node, fp, n, bands) of each distinct text: the fingerprint, the number of shingles, the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            own = b["text"].to_pylist()
            sets = [shingles(t) for t in own]
            fp = np.array([simhash.fingerprint(t) for t in own], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["node"], pa.array(fp), pa.array([len(s) for s in sets], pa.int64()), pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))], names=["node", "fp", "n", "bands"])

    return _texts(docs).mapInArrow(run, "node long, fp long, n long, bands array<long>").dropDuplicates(["node"])


def _fits(n: Column, m: Column) -> Column:
    return F.least(n, m) >= LEAST * F.greatest(n, m) - 1e-9


def members(nodes: DataFrame) -> DataFrame:
    """(k, key, node, n, texts, shingles, least): the texts of each bucket that has two or more; least is its least (node, n)."""
    rows = nodes.select("node", "n", F.posexplode("bands").alias("k", "key"))
    buckets = rows.groupBy("k", "key").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles"), F.min(F.struct("node", "n")).alias("least"))
    return rows.join(buckets.where("texts > 1"), ["k", "key"])


def candidates(of: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b), a > b: pairs of nodes to verify, from members() of sketches()."""
    few = of.where(F.col("texts") <= SMALL).select("k", "key", "node", "n")
    other = few.select("k", "key", F.col("node").alias("b"), F.col("n").alias("m"))
    within = few.join(other, ["k", "key"]).where("node > b").where(_fits(F.col("n"), F.col("m"))).select(F.col("node").alias("a"), "b")
    least = of.where((F.col("texts") > SMALL) & (F.col("node") > F.col("least.node")) & _fits(F.col("n"), F.col("least.n"))).select(F.col("node").alias("a"), F.col("least.node").alias("b"))
    same = nodes.groupBy("fp").agg(F.min("node").alias("id"))
    end = lambda c: same.select(F.col("fp").alias(c), F.col("id").alias(f"{c}_node"))
    index = simhash.links(same.select("fp")).join(end("a"), "a").join(end("b"), "b").select(F.greatest("a_node", "b_node").alias("a"), F.least("a_node", "b_node").alias("b"))
    equal = nodes.join(same, "fp").where("node <> id").select(F.col("node").alias("a"), F.col("id").alias("b"))
    return within.unionByName(least).unionByName(index).unionByName(equal).distinct()


def joined_components(table: pa.Table) -> pa.Table:
    """(a, b): components of a unit's texts (component, other, s) that similar texts join. Exact: all pairs of texts that are `other` and
    any texts of different components."""
    component, code = np.unique(table["component"].to_numpy(), return_inverse=True)
    sets = [np.frombuffer(v.as_buffer(), "<u8") for v in table["s"]]
    n, m = np.array([len(s) for s in sets], np.int64), len(sets)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    row, texts = np.repeat(np.arange(m), n), np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    # frequent shingles are columns of a table, the others' texts lie in lists
    common = texts > max(16, m // 16)
    column, at = np.cumsum(common) - 1, common[ids]
    table_of = np.zeros((m, int(common.sum())), np.float32)
    table_of[row[at], column[ids[at]]] = 1
    rare = ~at & (texts[ids] > 1)
    row, ids = row[rare], ids[rare]
    start = np.searchsorted(row, np.arange(m + 1))
    lists = row[np.argsort(ids, kind="stable")]
    begin = np.r_[0, np.cumsum(np.bincount(ids, minlength=len(texts)))]
    parent = list(range(len(component)))

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    edges = []
    others = np.flatnonzero(table["other"].to_numpy(zero_copy_only=False))
    for s in range(0, len(others), 16):
        own = others[s : s + 16]
        own_ids = ids[np.concatenate([np.arange(start[r], start[r + 1]) for r in own])]
        size = begin[own_ids + 1] - begin[own_ids]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[own_ids], size)
        of = np.repeat(np.repeat(np.arange(len(own)), start[own + 1] - start[own]), size)
        both = table_of[own] @ table_of.T + np.bincount(of * m + lists[place], minlength=len(own) * m).reshape(len(own), m)
        alike = (both >= LEAST * (n[own][:, None] + n - both) - 1e-9) & (code[own][:, None] != code)
        i, j = np.nonzero(alike)
        for pair in np.unique(code[own[i]].astype(np.int64) * len(component) + code[j]).tolist():
            x, y = root(pair // len(component)), root(pair % len(component))
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((int(component[max(x, y)]), int(component[min(x, y)])))
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def crowd_links(of: DataFrame, sets: DataFrame, label: DataFrame) -> DataFrame:
    """(a, b): components (label: id, component) that similar texts of one large bucket join."""
    large = of.where(F.col("texts") > SMALL).join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = large.groupBy("k", "key", "component").agg(F.count("*").alias("n"), F.sum("n").alias("size"))
    main = F.max_by("component", F.struct("n", "component")).alias("main")
    apart = held.groupBy("k", "key").agg(main, F.max_by("size", F.struct("n", "component")).alias("size"), F.max("n").alias("n"), F.count("*").alias("components")).where("components > 1").drop("components")
    rows = large.drop("n").join(apart, ["k", "key"]).withColumn("other", F.col("component") != F.col("main"))
    parts = lambda texts, size: F.ceil(F.greatest(texts * 2 / UNIT_TEXTS, size * 2 / UNIT_SHINGLES, F.lit(1.0))).cast("int")
    rows = rows.withColumns({"all_parts": parts(F.col("texts"), F.col("shingles")), "other_parts": parts(F.col("texts") - F.col("n"), F.col("shingles") - F.col("size"))})
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # a part of all texts meets a part of those outside the largest component: of two components one is outside
    every = rows.select("k", "key", place(F.col("all_parts")).alias("one"), each("other_parts").alias("two"), "node", "component", F.lit(False).alias("other"))
    others = rows.where("other").select("k", "key", each("all_parts").alias("one"), place(F.col("other_parts")).alias("two"), "node", "component", "other")
    units = every.unionByName(others).groupBy("k", "key", "one", "two", "node", "component").agg(F.bool_or("other").alias("other")).join(sets, "node")
    return units.groupBy("k", "key", "one", "two").applyInArrow(joined_components, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets (node, s) have the similarity LEAST or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b["sa"], b["sb"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= LEAST * (len(x) + len(y) - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    return two.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, s): the shingle sets of the texts of wanted (node), as bytes of sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            yield pa.RecordBatch.from_arrays([b["node"], pa.array([shingles(t).tobytes() for t in b["text"].to_pylist()], pa.binary())], names=["node", "s"])

    return _texts(docs).join(wanted, "node", "left_semi").dropDuplicates(["node"]).mapInArrow(run, "node long, s binary")


def groups(docs: DataFrame) -> DataFrame:
    """(id, component) of every text node that is similar to another, but for the components' least."""
    nodes = written(sketches(docs), "sketches")
    of = written(members(nodes), "buckets")
    pairs = written(candidates(of, nodes), "pairs")
    discard(nodes)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(of.where(F.col("texts") > SMALL).select("node")).distinct()
    sets = written(shingle_sets(docs, ends), "sets")
    first = written(verified(pairs.groupBy("a").agg(F.min("b").alias("b")), sets), "links")
    label = written(least_reachable(first), "labels")
    end = lambda c: label.select(F.col("id").alias(c), F.col("component").alias(f"{c}_in"))
    apart = pairs.join(end("a"), "a", "left").join(end("b"), "b", "left").where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b")
    links = written(first.unionByName(verified(apart, sets)), "links")
    found = written(least_reachable(links), "labels")
    crowds = written(crowd_links(of, sets, found), "links")
    out = found if crowds.isEmpty() else written(least_reachable(links.unionByName(crowds)), "labels")
    for table in (of, pairs, sets, first, label, links, crowds, *([] if out is found else [found])):
        discard(table)
    return out


def keep_one_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of similar texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_node().alias("node"))
    found = groups(docs).withColumnRenamed("id", "node")
    return keep_first(docs, rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
