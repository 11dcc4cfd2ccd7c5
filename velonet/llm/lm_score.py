"""Cross-entropy difference: target and background bigram models over one shared vocabulary score each document.

The models match: both count the same public tokenizer's ids, a start mark before each text, over one vocabulary (every id
counted in either), with the same discount; each row belongs to one of them, targets to the target model, all others to the
background. P(w | v) takes DISCOUNT off each bigram count and gives it to P(w), the id's count plus one over all. A document's
score is the mean, over its tokens, of the target model's loss less the background model's: lower is more like the target.
A row is never scored by its own counts: they are taken out of its model's first. What occurs in other rows too stays counted,
copies included.

Texts are tokenized once, into a table that counting and scoring read. Counts cover all rows; they are summed per batch and
per task before the shuffle, so frequent bigrams don't skew it. The counts of bigrams go to the tasks if they have at most
BROADCAST_ROWS rows, else documents' distinct bigrams are joined with them by a shuffle; both score by the same function of the
same whole numbers. Counts by id have a row for each id, 2 ** 20 at most, and always go to the tasks.

Defined cases: a null or empty text has no tokens and score 0; rows without a label aren't targets; several label rows of an id
make its rows targets if one says so; repeated rows count and are scored each, by each other's counts; without targets, the
target model is the vocabulary's even distribution; a very long text is one row, its bigrams counted whole; other columns,
whatever their names, aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, texts
from velonet.llm.tokens import default_path, encoder
from velonet.operators.scratch import written

DISCOUNT = 0.75
_WIDE = np.int64(1 << 20)
#: Stands before a text; no vocabulary has as many ids.
START = (1 << 20) - 1
#: 24 bytes each: at most 60 MB to every executor.
BROADCAST_ROWS = 2_500_000
#: Tokens that a task counts, and scores, at a time.
SLICE, SCORED = 1 << 20, 1 << 18


def tokenize(docs: DataFrame, labels: DataFrame | None = None, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", target: str = "quality = 1") -> DataFrame:
    """(doc_id, hit, ids): token ids of each row, and whether it is a target: one with a label row for which `target` holds.

    Labels may be as many as documents, so they meet the texts by a sort-merge join at every size."""
    path = tokenizer or default_path()
    d = texts(docs, id_col, text_col)
    if labels is None:
        d = d.withColumn("hit", F.lit(False))
    else:
        chosen = labels.where(target).select(F.col(label_id).cast("long").alias("doc_id"), F.lit(True).alias("hit")).distinct()
        d = d.join(chosen.hint("merge"), "doc_id", "left").select("doc_id", F.coalesce("hit", F.lit(False)).alias("hit"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            ids = encoder(path).encode_batch(b["text"].to_pylist())
            ends = np.cumsum([0, *map(len, ids)]) // 4
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["hit"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc_id", "hit", "ids"])

    return d.select("doc_id", "hit", "text").mapInArrow(run, "doc_id long, hit boolean, ids array<int>")


def _bigrams(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (first id * 2**20 + second id) of all rows in a row, and each row's number of tokens."""
    n = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    w = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[(np.cumsum(n) - n)[n > 0]] = START
    return v * _WIDE + w, n


def count_bigrams(tokens: DataFrame) -> DataFrame:
    """(bigram, n, n_target) over all rows of tokenize(): counts in the background's rows and in the targets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "ids", SLICE):
            keys, n = _bigrams(b["ids"])
            hit = np.repeat(np.array(b["hit"].to_pylist(), bool), n)
            bigram, where, total = np.unique(keys, return_inverse=True, return_counts=True)
            own = np.bincount(where[hit], minlength=len(bigram)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bigram), pa.array(total.astype(np.int64) - own), pa.array(own)], names=["bigram", "n", "n_target"])

    return tokens.select("hit", "ids").mapInArrow(count, "bigram long, n long, n_target long").groupBy("bigram").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


class Totals:
    """Of each model (background, target): how often each id is counted, as a bigram's first and as its second, and with how
    many seconds; how much is counted; the number of ids."""

    def __init__(self, counts: DataFrame):
        c = counts.select(F.shiftrightunsigned("bigram", 20).alias("v"), F.col("bigram").bitwiseAND(F.lit((1 << 20) - 1)).alias("w"), "n", "n_target")
        kinds = lambda n: F.count_if(F.col(n) > 0)
        by_v = c.groupBy("v").agg(F.sum("n"), F.sum("n_target"), kinds("n"), kinds("n_target")).toArrow()
        by_w = c.groupBy("w").agg(F.sum("n"), F.sum("n_target")).toArrow()
        full = lambda t, k: self._spread(t[0].to_numpy(), t[k].to_numpy())
        self.first, self.kinds, self.second = ([full(t, k) for k in (a, a + 1)] for t, a in ((by_v, 1), (by_v, 3), (by_w, 1)))
        self.all, self.size = [int(x.sum()) for x in self.second], by_w.num_rows

    @staticmethod
    def _spread(at: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(_WIDE, np.int64)
        out[at] = values
        return out

    def loss_difference(self, owner: np.ndarray, bigram: np.ndarray, own: np.ndarray, counts: tuple[np.ndarray, np.ndarray], hit: np.ndarray) -> np.ndarray:
        """For each of a row's distinct bigrams the target's loss less the background's, without the row's own counts.

        owner: places in hit, which says in which model a row is; sorted by owner, then bigram. own: how often the row has the
        bigram; counts: how often the models have it."""
        v, w = bigram >> 20, bigram & (_WIDE - 1)
        inside = hit[owner]
        sums = lambda key, x: (lambda u: np.bincount(u, weights=x)[u].astype(np.int64))(np.unique(owner * _WIDE + key, return_inverse=True)[1])
        own_v, own_w, own_all = sums(v, own), sums(w, own), np.bincount(owner, weights=own, minlength=len(hit)).astype(np.int64)[owner]
        out = np.zeros(len(bigram))
        for k, mine in ((0, ~inside), (1, inside)):
            mine = mine.astype(np.int64)
            n = counts[k] - mine * own
            # a second that no other row has isn't a kind any more
            kinds = self.kinds[k][v] - sums(v, mine * (n == 0) * (own > 0))
            first, second, total = self.first[k][v] - mine * own_v, self.second[k][w] - mine * own_w, self.all[k] - mine * own_all
            single = (second + 1) / (total + self.size)
            seen = np.divide(np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds * single, first, out=single.copy(), where=first > 0)
            out += np.log(seen) * (1 if k == 0 else -1)
        return out


def _distinct(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bigram, how often) of the distinct bigrams of each row, in order, and each row's number of tokens."""
    keys, n = _bigrams(ids)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((keys, owner))
    o, k = owner[order], keys[order]
    new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (k[1:] != k[:-1])]) if len(o) else np.zeros(0, np.int64)
    return o[new], k[new], np.diff(np.r_[new, len(o)]), n


def score_documents(tokens: DataFrame, counts: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_tokens, score) of each row of tokenize(). counts: count_bigrams() over these rows."""
    context = tokens.sparkSession.sparkContext
    totals = context.broadcast(Totals(counts))
    names = ["doc_id", "n_tokens", "score"]

    def scores(owner: np.ndarray, bigram: np.ndarray, own: np.ndarray, both: tuple, hit: np.ndarray, n: np.ndarray) -> np.ndarray:
        value = own * totals.value.loss_difference(owner, bigram, own, both, hit)
        return np.bincount(owner, weights=value, minlength=len(n)) / np.maximum(n, 1)

    if counts.count() <= broadcast_rows:
        t = counts.toArrow().sort_by("bigram")
        shared = context.broadcast(tuple(t[c].to_numpy() for c in ("bigram", "n", "n_target")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, *both = shared.value
            for b in by_size(batches, "ids", SCORED):
                owner, bigram, own, n = _distinct(b["ids"])
                at = np.searchsorted(known, bigram)
                hit = np.array(b["hit"].to_pylist(), bool)
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n), pa.array(scores(owner, bigram, own, tuple(c[at] for c in both), hit, n))], names=names)

        return tokens.select("doc_id", "hit", "ids").mapInArrow(run, "doc_id long, n_tokens long, score double")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "ids", SCORED):
            owner, bigram, own, _ = _distinct(b["ids"])
            yield pa.RecordBatch.from_arrays([pa.array(b["row"].to_numpy()[owner]), pa.array(bigram), pa.array(own)], names=["row", "bigram", "own"])

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["row"], b["doc_id"], b["hit"], pa.array(b["ids"].value_lengths(), pa.int64())], names=["row", "doc_id", "hit", "n_tokens"])

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "x", SCORED):
            x = b["x"].flatten()
            bigram, own, n, n_target = (x.field(k).to_numpy() for k in range(4))
            owner = np.repeat(np.arange(b.num_rows), b["x"].value_lengths().to_numpy(zero_copy_only=False))
            n_tokens, hit = b["n_tokens"].to_numpy(), np.array(b["hit"].to_pylist(), bool)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_tokens"], pa.array(scores(owner, bigram, own, (n, n_target), hit, n_tokens))], names=names)

    rows = written(tokens.select("doc_id", "hit", "ids").withColumn("row", F.monotonically_increasing_id()), "rows")
    met = rows.mapInArrow(distinct, "row long, bigram long, own long").join(counts, "bigram")
    met = met.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("bigram", "own", "n", "n_target"))).alias("x"))
    every = rows.mapInArrow(sizes, "row long, doc_id long, hit boolean, n_tokens long").join(met, "row", "left")
    none = F.array().cast("array<struct<bigram:bigint,own:bigint,n:bigint,n_target:bigint>>")
    return every.select("doc_id", "hit", "n_tokens", F.coalesce("x", none).alias("x")).mapInArrow(run_joined, "doc_id long, n_tokens long, score double")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, target: str = "quality = 1", tokenizer: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Counts, models and scores; see the module."""
    tokens = written(tokenize(docs, labels, tokenizer, target=target), "tokens")
    return score_documents(tokens, written(count_bigrams(tokens), "bigrams"), broadcast_rows)
