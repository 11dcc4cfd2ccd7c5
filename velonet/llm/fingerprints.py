"""Lempel-Ziv phrase fingerprints: likeness of documents as a compressor sees it.

A text is parsed into dictionary phrases: each is the shortest run, from where the last one ended, that isn't in the
dictionary yet, and joins it (an unfinished last run doesn't count). The phrases are hashed, and the SIZE least hashes are
the fingerprint; two fingerprints' likeness estimates the Jaccard index of their phrase sets from the least hashes of both.

compare_with_edited() needs each row's successor: rows go, by one shuffle of the texts, to stretches of the order, one a task,
which end at quantiles of (id, hash of the text), weighed by the texts' sizes. Rows that share an id, or have none, split too;
equal rows stay together, sorted on disk if need be, and are parsed once.

Defined cases: a null or empty text has no phrases, an empty fingerprint, and likeness 1 to another such text; texts with
fewer phrases than SIZE are compared exactly; equal texts have equal fingerprints; very long ones are parsed whole. Repeated
rows give a row each, each other's successors; rows that share an id are neighbours in the order of hashes of their texts; null
ids come last. A lone document is its own successor. Other columns, whatever their names, aren't read; empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, shuffle_partitions, text_node, texts
from velonet.operators.scratch import written

SIZE = 128
#: Bytes of text in a stretch of rows, which is a task.
STRETCH = 32 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = -(2**63)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(14, (n - 1).bit_length()), base, np.uint64)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have)
        have = _powers[base]
    return have


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def parse(text: str, seen: set[str], at: int = 0) -> list[int]:
    """Ends of the phrases of text from `at` on; seen is the dictionary so far, and grows.

    The dictionary holds every prefix of its phrases, so the search may start near the last phrase's length and go either way."""
    ends, n, guess, add = [], len(text), 1, seen.add
    while at < n:
        j = min(at + guess, n)
        if (p := text[at:j]) in seen:
            while p in seen and j < n:
                j += 1
                p = text[at:j]
            if p in seen:
                break
        else:
            while (q := text[at : j - 1]) and q not in seen:
                j, p = j - 1, q
        add(p)
        ends.append(j)
        guess, at = max(1, j - at - 1), j
    return ends


def hashes(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32-bit hashes of the phrases text[start:end]."""
    if not len(ends):
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mix(codes + np.uint64(1)) * _power(_BASE, len(codes))[: len(codes)], out=sums[1:])
    return (_mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(codes) + 1)[starts]) >> np.uint64(32)).astype(np.uint32)


def least(h: np.ndarray, size: int = SIZE) -> np.ndarray:
    h = np.unique(h if len(h) <= 4 * size else np.partition(h, 2 * size)[: 2 * size])
    return h[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    both = np.union1d(a, b)[:size]
    if not len(both):
        return 1.0
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


class Parsed:
    """A text, its fingerprint, and what its first two thirds leave for an edited text that begins alike."""

    def __init__(self, text: str, size: int = SIZE):
        self.text, self.size = text, size
        self.cut = len(text) - len(text) // 3
        seen: set[str] = set()
        ends = parse(text[: self.cut], seen)
        self.at = ends[-1] if ends else 0
        self.seen = seen.copy()
        k = len(ends)
        ends += parse(text, seen, self.at)
        e = np.array(ends, np.int64)
        h = hashes(text, np.r_[0, e[:-1]] if len(e) else e, e)
        self.common = h[:k]
        self.least = least(h, size)

    def edited(self, after: str) -> tuple[str, np.ndarray]:
        """The text with its last third replaced by as much of `after`, and its fingerprint. May be called once."""
        new = self.text[: self.cut] + after[: len(self.text) - self.cut]
        ends = np.array(parse(new, self.seen, self.at), np.int64)
        return new, least(np.r_[self.common, hashes(new, np.r_[self.at, ends[:-1]] if len(ends) else ends, ends)], self.size)


def fingerprint(text: str, size: int = SIZE) -> np.ndarray:
    return Parsed(text, size).least


def _text(h: np.ndarray) -> str:
    return h.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of each row, where it is: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            t = b["text"].to_pylist()
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([len(x) for x in t], pa.int64()), pa.array([_text(fingerprint(x, size)) for x in t], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def with_next(docs: DataFrame, stretch: int = STRETCH) -> tuple[DataFrame, int]:
    """(bucket, halo, pos, tie, doc_id, text) and the number of buckets: rows in buckets of neighbours by descending (pos, tie), each
    bucket with one more key's rows, the halo: what follows its last row. One shuffle moves the texts.

    Where buckets end comes from a table of the keys and sizes, without texts. What the driver sees is two keys for each bucket."""
    spark = docs.sparkSession
    d = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("pos"), text_node().alias("tie"), "doc_id", "text")
    n = shuffle_partitions(spark)
    keys = d.select("pos", "tie", (F.octet_length("text") + 64).alias("size")).groupBy("pos", "tie").agg(F.sum("size").alias("size"))
    keys = written(keys.repartitionByRange(n, F.desc("pos"), F.desc("tie")).select(F.spark_partition_id().alias("range"), "*"), "keys")
    ranges = keys.groupBy("range").agg(F.sum("size").alias("size")).orderBy("range").toPandas()
    total = int(ranges["size"].sum())
    if not total:
        return d.select(F.lit(0).alias("bucket"), F.lit(False).alias("halo"), "*"), 1
    each = max(1, min(stretch, -(-total // (4 * n))))
    shift = spark.createDataFrame(list(zip(ranges["range"].tolist(), (ranges["size"].cumsum() - ranges["size"]).tolist(), strict=True)), "range int, before long")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The first and last key of what a batch holds of each bucket, by the bytes before a key."""
        before: dict[int, int] = {}
        for b in batches:
            out = []
            for r, part in b.groupby("range", sort=False):
                end = part["size"].cumsum() + before.setdefault(r, int(part["before"].iloc[0]))
                before[r] = int(end.iloc[-1])
                for bucket, own in part.groupby((end - part["size"]) // each):
                    out.append((bucket, *own.iloc[0][["pos", "tie"]], *own.iloc[-1][["pos", "tie"]]))
            yield pd.DataFrame(out, columns=["bucket", "p0", "t0", "p1", "t1"]).astype("int64")

    sorted_ = keys.join(F.broadcast(shift), "range").repartition(n, "range").sortWithinPartitions("range", F.desc("pos"), F.desc("tie"))
    ends = sorted_.mapInPandas(place, "bucket long, p0 long, t0 long, p1 long, t1 long")
    ends = ends.groupBy("bucket").agg(F.max(F.struct("p0", "t0")).alias("top"), F.min(F.struct("p1", "t1")).alias("end")).orderBy("bucket").select("top.*", "end.*").toPandas().to_numpy()
    used = len(ends)
    shared = spark.sparkContext.broadcast(ends)

    @F.pandas_udf("bucket int, into int")
    def of(pos: pd.Series, tie: pd.Series) -> pd.DataFrame:
        ends = shared.value
        p, t = pos.to_numpy(), tie.to_numpy()
        lo, hi = np.zeros(len(p), np.int64), np.full(len(p), used - 1)  # the first bucket that doesn't end before the key
        while (lo < hi).any():
            mid = (lo + hi) // 2
            past = (ends[mid, 2] > p) | (ends[mid, 2] == p) & (ends[mid, 3] > t)
            lo, hi = np.where(past, mid + 1, lo), np.where(past, hi, mid)
        tops = (ends[lo, 0] == p) & (ends[lo, 1] == t)
        return pd.DataFrame({"bucket": lo, "into": np.where(tops, (lo - 1) % used, -1)})

    at = d.withColumn("at", of("pos", "tie"))
    two = F.array(F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("halo")), F.struct(F.col("at.into").alias("bucket"), F.lit(True).alias("halo")))
    each_ = F.explode(F.when(F.col("at.into") < 0, F.slice(two, 1, 1)).otherwise(two)).alias("x")
    return at.select(each_, "pos", "tie", "doc_id", "text").select("x.bucket", "x.halo", "pos", "tie", "doc_id", "text"), used


def compare_with_edited(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", stretch: int = STRETCH) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and the likeness to that and to the next document.

    The edited text: the last floor(n_chars / 3) code points are replaced by the first as many of the next document by
    descending id (after the last: the first)."""
    rows, n = with_next(texts(docs, id_col, text_col), stretch)
    rows = rows.repartitionById(n, "bucket").sortWithinPartitions("bucket", "halo", F.desc("pos"), F.desc("tie"), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(p: Parsed, text: str, after: np.ndarray) -> tuple:
        new, h = p.edited(text)
        return len(p.text), hashlib.sha256(new.encode()).hexdigest(), _text(p.least), _text(h), likeness(p.least, h, size), likeness(p.least, after, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, closed, twin = None, None, None  # twin: what follows from a text that its own copy follows
        for b in by_size(batches):
            out = []
            for bucket, halo, doc_id, text in zip(b["bucket"].to_pylist(), b["halo"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                if closed == bucket:
                    continue  # of the rows of the halo's key the first is the successor
                if before and before[1].text == text:
                    if twin is None:
                        p = Parsed(text, size)
                        twin = compared(p, text, p.least)
                    out.append((before[0], *twin))
                    now = (doc_id, before[1])
                else:
                    now, twin = (doc_id, Parsed(text, size)), None
                    if before:
                        out.append((before[0], *compared(before[1], text, now[1].least)))
                before, closed, twin = (None, bucket, None) if halo else (now, closed, twin)
            cols = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
