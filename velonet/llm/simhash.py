"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has bit i if more than half of the 64-bit shingle hashes have it. Fingerprints that differ in LIMIT bits at
most are linked; links() finds what connects them.

The distinct fingerprints are sorted by Gray rank, in ranges, one table for all. In Gray order neighbours share most bits, so
each node of a tree over them keeps the bits that all below it share (pattern and mask). A node's shared bits contain those of
the nodes above, so the differences of two nodes in bits that both share accumulate downwards: once they are more than LIMIT,
both groups are pruned as a whole; if no member of one can differ in more from one of the other, both are linked as a whole;
else their children are compared.

Ranges meet through their upper nodes: these, two numbers a range, go to every task, where each range's tree descends against
them and sends the fingerprints that are left to the later range. There they pass, batch by batch, through that range's tree. With n
fingerprints a node shares about log2 n leading bits, so a fingerprint meets about (log2 n) ** 2 / 2 nodes a level, not n.
Exact copies are one member. A range gives a spanning forest of its links, not all pairs.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any other; fewer than SHINGLE words
are one shingle; repeated rows give a row each; a null id never names a component unless it has no other; rows that share an id,
or have none, are joined by their fingerprints only; a very long text is hashed whole; other columns, whatever their names,
aren't read; empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, keep_first, text_bytes, text_node
from velonet.operators.graph import least_reachable
from velonet.operators.scratch import written

SHINGLE, SEED, LIMIT, FAN = 3, 42, 2, 8
#: Fingerprints in a range; ranges at least, so that small inputs are spread too, and at most: past RANGE * MOST_RANGES
#: fingerprints ranges grow instead. So the upper nodes, which go to every task, have 16 bytes * MOST_RANGES at most.
RANGE, LEAST_RANGES, MOST_RANGES = 1 << 15, 64, 1 << 14
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_VISITS = pa.schema([("to", pa.int32()), ("visitor", pa.int32()), ("fp", pa.int64())])


def shingle_hashes(text: bytes, n: int = SHINGLE) -> list[int]:
    w = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not w:
        return []
    grams = zip(*[w[k:] for k in range(n)], strict=False) if len(w) >= n else [w]
    return [xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams]


def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """Unsigned."""
    h = np.array(shingle_hashes(text, n), dtype="<u8")
    if not len(h):
        return 0
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, fp): a row for each row of docs; node is a hash of its text, fp the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            fp = np.array([fingerprint(t, n) for t in b["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["node"], pa.array(fp.view(np.int64))], names=["doc_id", "node", "fp"])

    return text_bytes(docs, id_col, text_col).withColumn("node", text_node()).mapInArrow(run, "doc_id long, node long, fp long")


def gray_rank(fp: F.Column) -> F.Column:
    """The place of fp in the order of the reflected Gray code (as a signed long)."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


class Tree:
    """Nodes over fingerprints in Gray order: node i of level k covers FAN ** k of them. A node's shared bits are those in
    which `every` (the AND of all below) and `some` (their OR) agree."""

    def __init__(self, fps: np.ndarray):
        self.every, self.some = [fps], [fps]
        while len(self.every[-1]) > 1:
            at = np.arange(0, len(self.every[-1]), FAN)
            self.every.append(np.bitwise_and.reduceat(self.every[-1], at))
            self.some.append(np.bitwise_or.reduceat(self.some[-1], at))
        self.top = len(self.every) - 1

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of `nodes`, child)."""
        which = np.repeat(np.arange(len(nodes)), FAN)
        child = nodes[which] * FAN + np.tile(np.arange(FAN), len(nodes))
        there = child < len(self.every[level - 1])
        return which[there], child[there]

    def below(self, level: int, node: int) -> np.ndarray:
        step = FAN**level
        return np.arange(node * step, min((node + 1) * step, len(self.every[0])))


def may_meet(every: np.ndarray, some: np.ndarray, pattern: np.ndarray, mask: np.ndarray, limit: int) -> np.ndarray:
    """Whether groups differ in `limit` at most of the bits that both share."""
    return np.bitwise_count((every ^ pattern) & ~(every ^ some) & mask) <= limit


def close_pairs(one: Tree, two: Tree, limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i in one, j in two) within `limit` bits whose links connect all such; of a tree with itself, i before j."""
    same, zero = one is two, np.zeros(1, np.int64)
    stack = [(one.top, two.top, zero, zero)]
    while stack:
        k, m, a, b = stack.pop()
        if len(a) > 1 << 16:
            half = len(a) // 2
            stack += [(k, m, a[:half], b[:half]), (k, m, a[half:], b[half:])]
            continue
        e, s, f, t = one.every[k], one.some[k], two.every[m], two.some[m]
        keep = may_meet(e[a], s[a], f[b], ~(f[b] ^ t[b]), limit)
        a, b = a[keep], b[keep]
        whole = np.bitwise_count((s[a] | t[b]) ^ (e[a] & f[b])) <= limit
        if not k and not m:
            yield (a[a < b], b[a < b]) if same else (a, b)
            continue
        for x, y in zip(a[whole].tolist(), b[whole].tolist(), strict=True):
            x, y = one.below(k, x), two.below(m, y)
            yield np.full(len(y), x[0]), y
            yield x, np.full(len(x), y[0])
        a, b = a[~whole], b[~whole]
        if k >= m:
            which, a = one.children(k, a)
            b = b[which]
        if m >= k:
            which, b = two.children(m, b)
            a = a[which]
        k, m = (k - 1 if k >= m else k), (m - 1 if m >= k else m)
        if same:
            a, b = a[a <= b], b[a <= b]
        stack.append((k, m, a, b))


def visits(tree: Tree, pattern: np.ndarray, mask: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): the members i that may lie within `limit` bits of what is below the upper node j."""
    a, b = np.zeros(len(pattern), np.int64), np.arange(len(pattern))
    for level in range(tree.top, -1, -1):
        keep = may_meet(tree.every[level][a], tree.some[level][a], pattern[b], mask[b], limit)
        a, b = a[keep], b[keep]
        if level:
            which, a = tree.children(level, a)
            b = b[which]
    return a, b


class Forest:
    """Drops pairs that earlier ones connect."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def grow(self, n: int) -> None:
        self.root = np.r_[self.root[:n], np.arange(len(self.root), n)]

    def add(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs connect what wasn't connected."""
        new = np.zeros(len(i), bool)
        apart = np.flatnonzero(self.root[i] != self.root[j])
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for k, x, y in zip(apart.tolist(), self.root[i[apart]].tolist(), self.root[j[apart]].tolist(), strict=True):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
                new[k] = True
        for x in up:
            up[x] = top(up[x])
        if up:
            to = np.arange(len(self.root))
            to[list(up)] = list(up.values())
            self.root = to[self.root]
        return new


class RangeLinks:
    """The links of one range: own members first, then visitors, batch by batch."""

    def __init__(self, limit: int):
        self.limit, self.parts, self.tree = limit, [], None

    def own(self, fps: np.ndarray) -> None:
        self.parts.append(fps)

    def _edges(self, pairs: Iterator[tuple[np.ndarray, np.ndarray]], left: np.ndarray, shift: int) -> Iterator[pa.RecordBatch]:
        for i, j in pairs:
            new = self.forest.add(i + shift, j)
            if new.any():
                yield pa.RecordBatch.from_arrays([pa.array(left[i[new]].view(np.int64)), pa.array(self.fps[j[new]].view(np.int64))], schema=_EDGES)

    def among(self) -> Iterator[pa.RecordBatch]:
        if self.tree is None and self.parts:
            self.fps = np.concatenate(self.parts)
            self.tree, self.forest = Tree(self.fps), Forest(len(self.fps))
            yield from self._edges(close_pairs(self.tree, self.tree, self.limit), self.fps, 0)

    def visitors(self, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from self.among()
        n = len(self.fps)
        self.forest.grow(n)
        self.forest.grow(n + len(fps))
        yield from self._edges(close_pairs(Tree(fps), self.tree, self.limit), fps, n)


def _stretches(c: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(value, first, after last) of each run of equal values."""
    v = c.to_numpy()
    cuts = (np.flatnonzero(v[1:] != v[:-1]) + 1).tolist()
    yield from ((int(v[s]), s, e) for s, e in zip([0, *cuts], [*cuts, len(v)], strict=True) if e > s)


def links(distinct: DataFrame, limit: int = LIMIT, range_size: int = RANGE) -> DataFrame:
    """distinct (fp) -> edges (a, b) of fingerprints within `limit` bits that connect all such."""
    spark = distinct.sparkSession
    d = distinct.select("fp", gray_rank(F.col("fp")).alias("rank"))
    n = max(LEAST_RANGES, min(MOST_RANGES, -(-d.count() // range_size)))
    order = F.col("rank").bitwiseXOR(F.lit(-(1 << 63)))  # unsigned
    table = written(d.select("fp", order.alias("rank")).repartitionByRange(n, "rank").select(F.spark_partition_id().alias("range"), "fp", "rank").sortWithinPartitions("rank"), "ranges")
    upper = table.groupBy("range").agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some")).toArrow().sort_by("range")
    number = upper["range"].to_numpy()
    every, some = (upper[c].to_numpy().view(np.uint64) for c in ("every", "some"))
    shared = spark.sparkContext.broadcast((number, every, ~(every ^ some)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pattern, mask = shared.value
        for b in batches:
            fps = b["fp"].to_numpy().view(np.uint64)
            for r, s, e in _stretches(b["range"]):
                own, later = fps[s:e], np.searchsorted(number, r, side="right")
                i, j = visits(Tree(own), pattern[later:], mask[later:], limit)
                to = np.r_[np.full(len(own), r), number[later:][j]]
                visitor = np.r_[np.zeros(len(own), np.int32), np.ones(len(i), np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(visitor), pa.array(np.r_[own, own[i]].view(np.int64))], schema=_VISITS)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = RangeLinks(limit), None
        for b in batches:
            fps, visitor = b["fp"].to_numpy().view(np.uint64), b["visitor"].to_numpy()
            for r, s, e in _stretches(b["to"]):
                if r != at:
                    yield from now.among()
                    now, at = RangeLinks(limit), r
                own = s + int(np.searchsorted(visitor[s:e], 1))
                if own > s:
                    now.own(fps[s:own])
                if e > own:
                    yield from now.visitors(fps[own:e])
        yield from now.among()

    parts = int(number.max(initial=0)) + 1
    sent = table.select("range", "fp").mapInArrow(send, "to int, visitor int, fp long").repartitionById(parts, "to")
    # visitors in Gray order again, so that their own tree prunes too
    return sent.sortWithinPartitions("to", "visitor", gray_rank(F.col("fp"))).mapInArrow(meet, "a long, b long").distinct()


def _labelled(docs: DataFrame, n: int, limit: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, fp) of each row, and (fp, component, id): the component's least fingerprint, the least id at fp."""
    fps = written(fingerprints(docs, n, id_col, text_col), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct")
    found = least_reachable(links(distinct.select("fp"), limit)).withColumnRenamed("id", "fp")
    return fps, distinct.join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), "id")


def near_duplicates(docs: DataFrame, n: int = SHINGLE, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, fp (long), fingerprint (16 hex digits), component_id (the least doc_id reachable)."""
    fps, of = _labelled(docs, n, limit, id_col, text_col)
    of = written(of, "components")
    named = of.groupBy("component").agg(F.min("id").alias("component_id"))
    # written, so that the join below reads both sides as they come and may split a fingerprint that very many rows share
    label = written(of.join(named, "component").select("fp", "component_id"), "labels")
    out = fps.join(label, "fp", "left")
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, n: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """docs with one row of each near-duplicate group; see keep_first()."""
    fps, of = _labelled(docs, n, limit)
    return keep_first(docs, fps.join(written(of, "labels"), "fp").select("doc_id", "node", "component"))
