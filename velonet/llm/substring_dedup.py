"""Substring dedup by difference-cover anchors.

Words are runs of characters other than ASCII white space. A window is WINDOW consecutive words of a document; each word
covered by a window whose words also start in a document with a smaller id is removed.

Which windows can repeat is found from anchors: windows of WINDOW - PERIOD + 1 words, hashed only at positions whose
remainder by PERIOD lies in a difference cover. Any two equal windows share, at one and the same shift, an anchor at a
cover position of both. Documents lie in chunks, which shuffle their texts once; then

1. anchors: a chunk sends its distinct anchors to buckets, a bucket answers with a bit each: does another chunk have it;
2. extension: a chunk sends the hashes of its distinct windows around shared anchors, with the least id that has each; a
   bucket answers with a bit each: has a smaller id of another chunk the window;
3. removal, from these bits and the chunk's own windows.

Equality: a word gets 128 bits from a universal hash (products of its keyed 32-bit lanes) whose keys are drawn anew in each
run, and a window the chain of its words' bits, each step of which is a bijection of the word. So two words that differ are
taken for equal with a probability of 2 ** -64 at most, whatever they are, for no one can choose words against the keys.
Within a chunk equal windows are compared byte by byte on top. Anchors are only met by 32 bits within a bucket; a false one
costs an extension.

Sizes: chunks and buckets are as many as the input has CHUNK_BYTES, so neither a chunk, a bucket nor a task grows with the
input; several share a task past PARTS. A passage that very many documents share is sent once per chunk, so no bucket grows
with its copies. A chunk is chosen by id, text and the partition that the row was read in, so rows that share an id (or have
none), equal ones too, spread.

Defined cases: null or empty texts have no words; rows that share an id are one document and don't remove each other's
windows; a null id counts as after all others; a very long text is one row of one chunk, whole; other columns, whatever their
names, aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import NO_ID, shuffle_partitions, text_bytes
from velonet.operators.scratch import written

WINDOW, PERIOD = 13, 7
#: Each remainder by PERIOD is a difference of two of these.
COVER = (0, 1, 3)
#: Bytes of text in a chunk: what a task holds at a time.
CHUNK_BYTES = 16 << 20
#: Tasks of a step at most; past it, a task takes several chunks one after the other.
PARTS = 20_000
#: 32-bit lanes of a word that its bits are made of; the bits of a longer word are a keyed BLAKE2b.
LANES = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_ANCHORS, _WINDOWS = 0, 1
_SIGN = np.uint64(1 << 63)


class Words:
    """Where the words of several texts are, with 128 keyed bits for each."""

    def __init__(self, texts: list[bytes], key: bytes):
        joined = b"\n".join(texts)
        self.bytes = np.frombuffer(joined + bytes(4 * LANES + 8), np.uint8)
        blank = np.ones(len(joined) + 2, bool)
        blank[1:-1] = _BLANK[self.bytes[: len(joined)]]
        change = np.flatnonzero(blank[1:] != blank[:-1])
        self.start, self.end = change[::2], change[1::2]
        after = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        self.counts = np.diff(np.searchsorted(self.start, np.r_[0, after])) if texts else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        first = np.cumsum(self.counts) - self.counts
        self.pos = np.arange(len(self.doc)) - first[self.doc]
        self.bits = self._bits(joined, key)

    def _bits(self, joined: bytes, key: bytes) -> list[np.ndarray]:
        keys = np.frombuffer(hashlib.shake_256(key).digest(4 * 4 * (LANES + 2)), np.uint32).reshape(4, LANES + 2)
        size = self.end - self.start
        lanes = np.lib.stride_tricks.as_strided(self.bytes[:4].view(np.uint32), (len(self.bytes) - 3,), (1,))
        product = lambda x, y: x.astype(np.uint64) * y.astype(np.uint64)
        sums = [product(size.astype(np.uint32) + k[-2], k[-1:]) for k in keys]
        for j in range(0, LANES, 2):
            some = np.flatnonzero(size > 4 * j) if j else slice(None)
            start, left = self.start[some] + 4 * j, size[some] - 4 * j
            x, y = lanes[start] & _MASKS[np.minimum(left, 4)], lanes[start + 4] & _MASKS[np.clip(left - 4, 0, 4)]
            for k, s in zip(keys, sums, strict=True):
                s[some] += product(x + k[j], y + k[j + 1])
        bits = [(s * _STEP) ^ (t << np.uint64(32) | t >> np.uint64(32)) for s, t in (sums[:2], sums[2:])]
        for i in np.flatnonzero(size > 4 * LANES).tolist():
            digest = hashlib.blake2b(joined[self.start[i] : self.end[i]], digest_size=16, key=key).digest()
            bits[0][i], bits[1][i] = np.frombuffer(digest, np.uint64)
        return bits

    def starts(self, n: int) -> np.ndarray:
        """Numbers of the words at which a run of n words of one document begins."""
        return np.flatnonzero(self.pos + n <= self.counts[self.doc])

    def hash(self, at: np.ndarray, n: int, half: int) -> np.ndarray:
        """Of the n words from each of `at` on."""
        h, bits = np.zeros(len(at), np.uint64), self.bits[half]
        for k in range(n):
            h ^= bits[at + k]
            h *= _STEP
            h ^= h >> np.uint64(32)
        return h


def _anchors(w: Words, window: int, period: int, cover: tuple[int, ...], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words where anchors begin; for each its bucket (upper half) and 32 bits (lower half)."""
    n = window - period + 1
    at = w.starts(n)
    at = at[np.isin(w.pos[at] % period, cover)]
    h = w.hash(at, n, 0)
    return at, ((h >> np.uint64(32)) % np.uint64(n_buckets)) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, after last) of each run of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True) if len(values) else ()


_BLOB = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
_BLOB_SQL = "part int, chunk int, bucket int, kind int, data binary"


def _rows(rows: list[tuple[int, int, int, bytes]], parts: int, to: str) -> pa.Table:
    """Rows (chunk, bucket, kind, data), for the task of the chunk or of the bucket."""
    part = [r[0 if to == "chunk" else 1] % parts for r in rows]
    return pa.table([pa.array(part, pa.int32()), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(_BLOB.types[1:])]], schema=_BLOB)


def _bits(answer: pa.Table, kind: int) -> dict[int, np.ndarray]:
    """Of each bucket that answered: its bits, some zeros after them."""
    own = answer.filter(pa.array(np.equal(answer["kind"].to_numpy(), kind)))
    return {b: np.unpackbits(np.frombuffer(d, np.uint8)).view(bool) for b, d in zip(own["bucket"].to_pylist(), own["data"].to_pylist(), strict=True)}


def _answered(buckets: np.ndarray, bits: dict[int, np.ndarray]) -> np.ndarray:
    """The bits of records that are sorted by bucket, as they were sent."""
    out = np.zeros(len(buckets), bool)
    for s, e in _runs(buckets):
        out[s:e] = bits[int(buckets[s])][: e - s]
    return out


def same_text(w: Words, at: np.ndarray, to: np.ndarray, window: int) -> np.ndarray:
    """Whether the windows from each of `at` and of `to` have the same words."""
    out = np.ones(len(at), bool)
    for k in range(window):
        s, t = w.start[at + k], w.start[to + k]
        size = w.end[at + k] - s
        out &= size == w.end[to + k] - t
        for j in range(min(4 * LANES, int(size[out].max(initial=0)))):
            more = np.flatnonzero(out & (size > j))
            out[more] = w.bytes[s[more] + j] == w.bytes[t[more] + j]
        for i in np.flatnonzero(out & (size > 4 * LANES)).tolist():
            out[i] = np.array_equal(w.bytes[s[i] : s[i] + size[i]], w.bytes[t[i] : t[i] + size[i]])
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the kept words joined by one blank)."""
    if {(a - b) % period for a in cover for b in cover} != set(range(period)) or window <= period:
        raise ValueError("cover must be a difference cover of period, and window longer than period")
    d = text_bytes(docs, id_col, text_col)
    size = d.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(shuffle_partitions(docs.sparkSession), -(-size // chunk_bytes))
    parts, key = min(n, PARTS), secrets.token_bytes(16)
    d = d.select(F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n)).cast("int").alias("chunk"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    # written: equal rows are dealt out by the partition that they are read in, and every later step must meet the same chunks,
    # also where a lost executor's tasks run again behind a source whose partitions aren't fixed
    d = written(d.select((F.col("chunk") % parts).alias("part"), "*"), "chunks").repartitionById(parts, "part")

    def load(t: pa.Table) -> tuple[int, np.ndarray, Words]:
        return t["chunk"][0].as_py(), t["doc_id"].to_numpy(), Words(t["text"].to_pylist(), key)

    def own_anchors(w: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words where anchors begin and their keys; the distinct keys in order, and which of them two documents here have."""
        at, keys = _anchors(w, window, period, cover, n)
        distinct, where = np.unique(keys, return_inverse=True)
        own = ids[w.doc[at]]
        least, most = np.full(len(distinct), NO_ID), np.full(len(distinct), -NO_ID - 1)
        np.minimum.at(least, where, own)
        np.maximum.at(most, where, own)
        return at, where, distinct, least < most

    def send_anchors(t: pa.Table) -> pa.Table:
        chunk, ids, w = load(t)
        distinct = own_anchors(w, ids)[2]
        low = distinct.astype(np.uint32)
        return _rows([(chunk, int(distinct[s] >> np.uint64(32)), _ANCHORS, low[s:e].tobytes()) for s, e in _runs(distinct >> np.uint64(32))], parts, "bucket")

    def shared_anchors(t: pa.Table) -> pa.Table:
        blobs = t["data"].to_pylist()
        ends = np.cumsum([len(b) // 4 for b in blobs])
        h = np.frombuffer(b"".join(blobs), np.uint32)
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        shared = np.zeros(len(h), bool)
        shared[order] = np.r_[same, False] | np.r_[False, same]
        return _rows([(c, b, _ANCHORS, np.packbits(x).tobytes()) for c, b, x in zip(t["chunk"].to_pylist(), t["bucket"].to_pylist(), np.split(shared, ends[:-1]), strict=True)], parts, "chunk")

    def windows(w: Words, ids: np.ndarray, answer: pa.Table) -> tuple[np.ndarray, ...]:
        """Windows with a shared anchor, equal ones side by side and least id first: (where they begin, ids, whether the first
        of its words, that first one's place); then the firsts as they are sent: (places, buckets, both hash halves)."""
        at, where, distinct, here = own_anchors(w, ids)
        hot = at[(here | _answered(distinct >> np.uint64(32), _bits(answer, _ANCHORS)))[where]]
        mark = np.zeros(len(w.doc) + 1, np.int64)  # a window that begins up to period - 1 words before holds the anchor
        np.add.at(mark, np.maximum(hot - (period - 1), 0), 1)
        np.add.at(mark, hot + 1, -1)
        starts = w.starts(window)
        starts = starts[np.cumsum(mark)[starts] > 0]
        h0, h1, own = w.hash(starts, window, 0), w.hash(starts, window, 1), ids[w.doc[starts]]
        order = np.lexsort((own, h0, h1))
        starts, h0, h1, own = starts[order], h0[order], h1[order], own[order]
        first = np.ones(len(starts), bool)
        first[1:] = (h1[1:] != h1[:-1]) | (h0[1:] != h0[:-1])
        same = np.flatnonzero(~first)
        first[same[~same_text(w, starts[same], starts[same - 1], window)]] = True
        at_first = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        sent = np.flatnonzero(first)
        bucket = (h0[sent] >> np.uint64(32)) % np.uint64(n)
        sent = sent[np.lexsort((h1[sent], own[sent], bucket))]  # by content alone, so that the bits are met again
        return starts, own, at_first, sent, (h0[sent] >> np.uint64(32)) % np.uint64(n), h0[sent], h1[sent]

    def send_windows(key_: tuple, left: pa.Table, answer: pa.Table) -> pa.Table:
        if not left.num_rows or not answer.num_rows:
            return _rows([], parts, "bucket")
        chunk, ids, w = load(left)
        _, own, _, sent, bucket, h0, h1 = windows(w, ids, answer)
        own, low = own[sent].view(np.uint64) ^ _SIGN, h0.astype(np.uint32)  # unsigned, in the ids' order
        step = lambda s, e: np.diff(own[s:e], prepend=np.uint64(0)).tobytes()  # small numbers, which compress
        return _rows([(chunk, int(bucket[s]), _WINDOWS, h1[s:e].tobytes() + low[s:e].tobytes() + step(s, e)) for s, e in _runs(bucket)], parts, "bucket")

    def earlier_windows(t: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(b, np.uint8) for b in t["data"].to_pylist()]
        size = [len(b) // 20 for b in blobs]
        take = lambda lo, hi, kind: np.concatenate([b[lo * k : hi * k].view(kind) for b, k in zip(blobs, size, strict=True)])
        h1, low = take(0, 8, np.uint64), take(8, 12, np.uint32)
        own = np.concatenate([np.cumsum(b[12 * k :].view(np.uint64)) for b, k in zip(blobs, size, strict=True)])
        order = np.lexsort((own, low, h1))
        first = np.ones(len(h1), bool)
        first[1:] = (h1[order[1:]] != h1[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
        least = own[order][np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
        later = np.zeros(len(h1), bool)
        later[order] = least < own[order]
        return _rows([(c, b, _WINDOWS, np.packbits(x).tobytes()) for c, b, x in zip(t["chunk"].to_pylist(), t["bucket"].to_pylist(), np.split(later, np.cumsum(size)[:-1]), strict=True)], parts, "chunk")

    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def remove(key_: tuple, left: pa.Table, answer: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out.empty_table()
        _, ids, w = load(left)
        texts = left["text"].to_pylist()
        mark = np.zeros(len(w.doc) + 1, np.int64)
        if answer.num_rows:
            starts, own, at_first, sent, bucket, _, _ = windows(w, ids, answer)
            earlier = np.zeros(len(starts), bool)
            earlier[sent] = _answered(bucket, _bits(answer, _WINDOWS))
            bad = starts[earlier[at_first] | (own > own[at_first])]
            np.add.at(mark, bad, 1)
            np.add.at(mark, bad + window, -1)
        drop = np.cumsum(mark)[:-1] > 0
        ends = np.cumsum(w.counts)
        gone = np.r_[0, np.cumsum(drop)]
        n_removed = gone[ends] - gone[ends - w.counts] if len(ends) else np.zeros(0, np.int64)
        kept = []
        for t, e, c, r in zip(texts, ends.tolist(), w.counts.tolist(), n_removed.tolist(), strict=True):
            kept.append(b" ".join(itertools.compress(t.split(), ~drop[e - c : e]) if r else t.split()).decode())
        real = pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64())
        return pa.table([real, pa.array(w.counts), pa.array(n_removed), pa.array(kept, pa.string())], schema=out)

    by_chunk = d.groupBy("part", "chunk")
    to = lambda df: df.repartitionById(parts, "part")
    shared = to(by_chunk.applyInArrow(send_anchors, _BLOB_SQL)).groupBy("part", "bucket").applyInArrow(shared_anchors, _BLOB_SQL)
    again = by_chunk.cogroup(to(shared).groupBy("part", "chunk")).applyInArrow(send_windows, _BLOB_SQL)
    earlier = to(again).groupBy("part", "bucket").applyInArrow(earlier_windows, _BLOB_SQL)
    return by_chunk.cogroup(to(shared.unionByName(earlier)).groupBy("part", "chunk")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept string")


def kept_digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of what remove_repeats() returns."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
