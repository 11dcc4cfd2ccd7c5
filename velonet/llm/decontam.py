"""Benchmark decontamination: a hash set of normalised test n-grams meets every token window of the training texts.

Words are runs of ASCII digits, letters (A-Z lower-cased) and all characters beyond ASCII. A window is n consecutive words
of a test item; an item with fewer words, but some, is one window. A document word inside any occurrence is hit.
Windows are met by hash and verified word by word. The test set goes to the tasks in blocks of bounded size, as sorted arrays
that the driver makes one block at a time, and one pass over the texts for each block; hits of several blocks are joined by
position. A worker holds the arrays of a block once, whatever the number of its tasks: about 6 bytes for a byte of items.

Defined cases: null or empty texts have no words and aren't contaminated; null or empty items have no windows; an item
without an id hits and removes like any other, but isn't among items and n_items; repeated rows of documents give a row each,
repeated items count once; a very long text is searched whole; other columns, whatever their names, aren't read, and pass
remove_contaminated() as they are; empty tables give empty results or clean documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, text_bytes

WINDOW = 10
#: Bytes of test items that one pass broadcasts.
BLOCK_BYTES = 16 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


class Windows:
    """The windows of one length: sorted hashes; of each window a place in the words and which items have it."""

    def __init__(self, m: int, words_: np.ndarray, starts: np.ndarray, owner: np.ndarray):
        self.m = m
        h = roll([words_[starts + k] for k in range(m)])
        order = np.lexsort((owner, h))
        h, starts, owner = h[order], starts[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        clash = np.flatnonzero(~new)
        clash = clash[~_equal(words_, starts[clash], words_, starts[clash - 1], m)]
        if len(clash):  # different windows of one hash: sort these by their words as well
            some = np.isin(h, h[clash])
            at = np.flatnonzero(some)
            again = np.lexsort((owner[at], *[words_[starts[at] + k] for k in range(m)], h[at]))
            starts[at], owner[at] = starts[at][again], owner[at][again]
            same = _equal(words_, starts[at[1:]], words_, starts[at[:-1]], m) & (h[at[1:]] == h[at[:-1]])
            new[at] = np.r_[True, ~same]
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        twice = np.r_[False, (number[1:] == number[:-1]) & (owner[1:] == owner[:-1])]
        self.hash, self.start = h[first], starts[first].astype(np.int32)
        self.items = owner[~twice].astype(np.int32)
        self.bounds = np.r_[0, np.cumsum(np.bincount(number[~twice], minlength=len(first)))].astype(np.int32)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hash >> np.uint64(44)] = True

    def find(self, text: np.ndarray, at: np.ndarray, words_: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of places in the text with their hashes: (which of them, window) that have the same words."""
        which, window = [], []
        lo = np.searchsorted(self.hash, h)
        k = 0
        while len(lo):
            here = np.flatnonzero((lo + k < len(self.hash)) & (self.hash[np.minimum(lo + k, len(self.hash) - 1)] == h)) if len(self.hash) else np.zeros(0, np.int64)
            if not len(here):
                break
            w = lo[here] + k
            ok = _equal(text, at[here], words_, self.start[w], self.m)
            which.append(here[ok])
            window.append(w[ok])
            k += 1
        return (np.concatenate(which), np.concatenate(window)) if which else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def roll(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * _BASE
        h ^= h >> np.uint64(29)
    return h


def _equal(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, m: int) -> np.ndarray:
    """Whether the m words of x from each of i are those of y from each of j."""
    out = np.ones(len(i), bool)
    for k in range(m):
        out &= x[i + k] == y[j + k]
    return out


class TestSet:
    """Windows of the items, found by a rolling hash over word numbers and verified word by word, all in arrays."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, bytes]], n: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.names = sorted({i for i, _ in items if i is not None})
        place = {None: len(self.names)} | {i: k for k, i in enumerate(self.names)}  # items without an id come last
        numbers, sizes = [], []
        for _, text in items:
            w = words(text)
            sizes.append(len(w))
            numbers += [self.number.setdefault(x, len(self.number) + 1) for x in w]
        self.words = np.array(numbers, np.int32)
        sizes, item = np.array(sizes, np.int64), np.array([place[i] for i, _ in items], np.int64)
        first = np.cumsum(sizes) - sizes
        self.windows = []
        for m in sorted({min(n, s) for s in sizes.tolist() if s}):
            own = np.flatnonzero(sizes == m if m < n else sizes >= n)
            count = sizes[own] - m + 1
            starts = np.repeat(first[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            self.windows.append(Windows(m, self.words, starts, np.repeat(item[own], count)))

    def hits(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Of each text: words, hit (first, after last) word ranges in order, names of items. Words unknown to the test set are
        number 0."""
        get, counts, numbers = self.number.get, [], []
        for t in texts:
            w = [get(x, 0) for x in words(t)]
            counts.append(len(w))
            numbers += w
        text, ends = np.array(numbers, np.int32), np.cumsum(counts)
        owner_start = ends - counts
        ranges: list[set[tuple[int, int]]] = [set() for _ in texts]
        items: list[set[int]] = [set() for _ in texts]
        for x in self.windows:
            if len(text) < x.m:
                continue
            h = roll([text[k : len(text) - x.m + 1 + k] for k in range(x.m)])
            at = np.flatnonzero(x.seen[h >> np.uint64(44)])
            doc = np.searchsorted(ends, at, side="right")
            ok = at + x.m <= ends[doc]
            at, doc = at[ok], doc[ok]
            which, window = x.find(text, at, self.words, h[at])
            at, doc = at[which] - owner_start[doc[which]], doc[which]
            for d, s in zip(doc.tolist(), at.tolist(), strict=True):
                ranges[d].add((s, s + x.m))
            for d, w in sorted(set(zip(doc.tolist(), window.tolist(), strict=True))):
                items[d].update(x.items[x.bounds[w] : x.bounds[w + 1]].tolist())
        return [(c, sorted(r), [self.names[k] for k in sorted(i) if k < len(self.names)]) for c, r, i in zip(counts, ranges, items, strict=True)]


def _covered(ranges: list[tuple[int, int]]) -> int:
    n = at = 0
    for s, e in sorted(ranges):
        n += max(0, e - max(s, at))
        at = max(at, e)
    return n


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """The test set in parts of about block_bytes, dealt out by a hash of text and item, so that a text of very many items is dealt
    out too; repeated rows are one. Each part is brought to the driver by itself, when it is asked for."""
    b = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")).where("text is not null").distinct()
    total = b.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield [(r.item, bytes(r.text)) for r in b.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k).toLocalIterator()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted), spans (hit word ranges, not merged), contaminated."""
    spark = docs.sparkSession
    base = text_bytes(docs, id_col, text_col)
    # one block after the other: what stays of each is the broadcast, in files
    shared = [spark.sparkContext.broadcast(TestSet(p, n)) for p in blocks(benchmark, item_col, item_text_col, block_bytes)]
    shared = shared or [spark.sparkContext.broadcast(TestSet([], n))]
    schema = "doc_id long, key binary, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"

    def scan_of(block, several: bool):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = block.value
            for b in by_size(batches):
                texts = b["text"].to_pylist()
                found = tests.hits(texts)
                keys = [hashlib.sha256(t).digest() if several else None for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], pa.array(keys, pa.binary()), pa.array([c for c, _, _ in found], pa.int64()), pa.array([_covered(r) for _, r, _ in found], pa.int64()), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
                    + [pa.array([[{"start": s, "end": e} for s, e in r] for _, r, _ in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=["doc_id", "key", "n_words", "n_hit", "items", "spans"],
                )

        return scan

    scans = [base.mapInArrow(scan_of(block, len(shared) > 1), schema) for block in shared]
    out = scans[0]
    if len(scans) > 1:
        out = _union_blocks(scans)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def _union_blocks(scans: list[DataFrame]) -> DataFrame:
    """Joins the hits that blocks found in a document; repeated rows (same id and text) stay as many as they were."""
    tagged = [s.withColumn("block", F.lit(k)) for k, s in enumerate(scans)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    one = every.groupBy("doc_id", "key", "n_words").agg(F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).alias("copies"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"))
    merged = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("at")), lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["at"]))).alias("n"), F.greatest(a["at"], s["end"]).alias("at")))
    return one.withColumn("n_hit", merged["n"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "key", "n_words", "n_hit", "items", "spans")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_bytes: int = BLOCK_BYTES, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without the rows whose text holds a window of the test set; all other rows and columns as they are.

    The rows don't move: each block of the test set filters them where they are."""
    out = docs
    for part in blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(TestSet(part, n))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for b in by_size(batches):
                texts = [(t or "").encode() for t in b["text"].to_pylist()]
                yield b.filter(pa.array([not r for _, r, _ in tests.hits(texts)], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out
