"""Best-fit packing with certified bounds.

Documents become token ids (plus an end id); ones over the capacity are cut into full pieces and a rest. Pieces are dealt
out to groups of bounded size, each packed by best-fit decreasing and certified by lower bounds from dual-feasible
functions. Groups that need more sequences than their bound give the documents of their sequences with space left to a
common pool, which is dealt out anew and packed again, as long as that saves sequences. The certificates are in the result:
each piece has its group's number of sequences and bound, equal where nothing can be saved.

Defined cases: a null or empty text is the end id alone; a very long one is cut into pieces, which lie where they fit; an empty
table gives an empty result; repeated rows are packed each, dealt out by their place in the written table, so they don't meet
in one group; a null doc_id stays null; extra columns are ignored. No piece is dropped, and only longer documents are cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, texts
from velonet.llm.tokens import default_path, encoder
from velonet.operators.scratch import discard, written

CAPACITY = 2048
#: Pieces to a group: what one task packs at once. Groups grow in number, not in size.
GROUP = 25_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every document."""
    path = tokenizer or default_path()
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in by_size(batches):
            rows: list[tuple] = []
            for i, ids in zip(b["doc_id"].to_pylist(), enc.encode_batch(b["text"].to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                rows += [(i, k, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)])) for k, s in enumerate(range(0, n, capacity))]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs, id_col, text_col).mapInArrow(cut, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs: the best over dual-feasible functions.

    f maps sizes so that whatever fits one bin has images of a sum of 1 at most; then the images' sum bounds the bins.
    Used: the identity; for each split e up to half the capacity, sizes over capacity - e count as whole bins, sizes under e
    as nothing; for k up to 20, sizes rounded down to k-ths unless (k + 1) x / capacity is whole."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    n_upto, s_upto = np.cumsum(count), np.cumsum(count * size)
    e = np.arange(1, capacity // 2 + 1)
    big, mid = n_upto[-1] - n_upto[capacity - e], s_upto[capacity - e] - s_upto[e - 1]
    best = max(best, int((big + -(-mid // capacity)).max(initial=0)))
    for k in range(1, 21):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        image = np.where(whole, size * k, (scaled // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * image).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece. Longest first, each into the fullest bin that takes it; ties: earlier pieces, later bins."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by space left
    some, n = 0, 0  # bit r is set if a bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fit = some >> need
        if fit:
            left = need + (fit & -fit).bit_length() - 1
            b = free[left].pop()
            if not free[left]:
                some &= ~(1 << left)
        else:
            b, left, n = n, capacity, n + 1
        bins[i], offsets[i] = b, capacity - left
        if left - need:
            free[left - need].append(b)
            some |= 1 << (left - need)
    return bins, offsets


def _deal(df: DataFrame, n: int, salt: int) -> DataFrame:
    return df.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)))


def _pack(pieces: DataFrame, capacity: int, tag: int) -> DataFrame:
    """Each group packed: + sequence_id, offset, left (space in the sequence), bins and bound of the group."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        lengths = t["length"].to_numpy()
        b, offset = best_fit_decreasing(lengths, capacity)
        n = int(b.max()) + 1
        left = capacity - np.bincount(b, weights=lengths, minlength=n).astype(np.int64)
        group = t["grp"][0].as_py()
        own = [("sequence_id", b + (tag << 48) + (group << 24)), ("offset", offset), ("left", left[b]), ("bins", np.full(len(b), n)), ("bound", np.full(len(b), lower_bound(lengths, capacity)))]
        for name, x in own:
            t = t.append_column(name, pa.array(x, pa.int64()))
        return t

    return pieces.groupBy("grp").applyInArrow(run, f"{PIECES}, row long, grp long, sequence_id long, offset long, left long, bins long, bound long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int | None = None) -> DataFrame:
    """pieces (see tokenize) + sequence_id, offset, group_sequences, group_bound. Sequences are gapless from 0 and at most
    `capacity` long; a group is what was packed at once, a full piece one by itself. rounds: of exchanges, at most; None: until
    one saves nothing."""
    own = [c.split()[0] for c in PIECES.split(", ")]
    columns = [*own, "sequence_id", "offset", F.col("bins").alias("group_sequences"), F.col("bound").alias("group_bound")]
    table = written(pieces.select(*own, F.monotonically_increasing_id().alias("row")), "pieces")
    # full pieces are sequences of their own; their ids are negative, so that they can't meet the packed ones
    whole = table.where(F.col("length") == capacity).select("*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("bins"), F.lit(1).cast("long").alias("bound")).select(*columns)
    part = table.where(F.col("length") < capacity)
    n = part.count()
    if not n:
        return whole
    packed = written(_pack(_deal(part, -(-n // group), 0), capacity, 0), "packed")
    kept, salt = [], 0
    gap = (F.col("bins") > F.col("bound")) & (F.col("left") > 0)
    while rounds is None or salt < rounds:
        salt += 1
        m, before = packed.agg(F.count_if(gap), F.count_if(gap & (F.col("offset") == 0))).first()
        if not m:
            break
        again = written(_pack(_deal(packed.where(gap).select(*own, "row"), -(-m // group), salt), capacity, salt), "packed")
        if again.where(F.col("offset") == 0).count() >= before:
            discard(again)
            break
        kept.append(packed.where(~gap).select(*columns))
        packed = again
    kept.append(packed.select(*columns))
    for x in kept:
        whole = whole.unionByName(x)
    return whole


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenizes and packs whole documents; see tokenize() and pack()."""
    return pack(tokenize(docs, capacity, 0, tokenizer, id_col, text_col), capacity)
