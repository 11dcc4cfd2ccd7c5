"""Ordinal quality classifier: cumulative-link regression on graded ratings over hashed text features.

One weight vector is shared by all grades; ordered thresholds part them: P(grade > k) = sigmoid(f(text) - threshold k).
f sums the mean weight of the text's hashed words and the weights of hashed shape features (shares of capitals, repeats,
marks and the like, in tenths). It gives the expected grade and, for selection, tail probabilities.

It is fitted on at most SAMPLE labelled documents, by their ids' hash; scores cover every row where it is, without a
shuffle. Defined cases: null and empty texts have only shape features; unlabelled rows are scored alike; repeated rows give
a row each; very long texts are read whole, in slices of rows by size; of several labels of an id the least counts; with no labels
every weight is zero; other columns, whatever their names, aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, texts
from velonet.llm.labelled import sample

#: Labelled documents that the fit may use: what the driver holds is their hashed features, about 2 kB each.
SAMPLE = 6_000
DIMENSIONS = 1 << 16
#: How strongly the mean word weight counts against shape features.
WORDS = 8.0
#: Grade 0: bad; 1: sound but toxic; 2: sound.
GRADES = "case when quality = 0 then 0 when toxic = 1 then 1 when quality = 1 then 2 end"
_MARKS = str.maketrans("", "", ".,;:!?\"'()")
_words: dict[str, int] = {}


def _word(w: str) -> int:
    i = _words.get(w)
    if i is None:
        if len(_words) > 400_000:
            _words.clear()
        i = _words[w] = zlib.crc32(w.translate(_MARKS).lower().encode()) % DIMENSIONS
    return i


def _shape(text: str, words: list[str]) -> list[int]:
    n, chars = max(1, len(words)), max(1, len(text))
    joined = "".join(words)
    shares = {
        "capitals": sum(map(str.isupper, words)) / n,
        "letters": sum(map(str.isalpha, words)) / n,
        "repeats": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        "distinct": len(set(words)) / n,
        "bars": text.count("|") * 5 / chars,
        "marks": sum(map(joined.count, "#$%&*!@")) * 5 / chars,
        "digits": sum(map(joined.count, "0123456789")) * 2 / chars,
        "lines": text.count("\n") * 10 / chars,
        "length": min(1.0, len(text).bit_length() / 20),
        "word": min(1.0, len(joined) / n / 20),
    }
    return [zlib.crc32(f"shape {k} {min(10, int(10 * v))}".encode()) % DIMENSIONS for k, v in shares.items()]


def features(text: str) -> tuple[list[int], list[int]]:
    """Hashed words, with repeats, and hashed shape features."""
    words = text.split()
    return [_word(w) for w in words], _shape(text, words)


@dataclass
class Ordinal:
    """weights of the hashed features and the thresholds, in rising order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def f(self, text: str) -> float:
        words, shape = features(text)
        return float((WORDS * self.weights[words].mean() if words else 0.0) + self.weights[shape].sum())

    def tails(self, f: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - f[:, None], -500, 500)))


def fit(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, grades: int, steps: int = 150, rate: float = 0.1, ridge: float = 1e-5) -> Ordinal:
    """Cumulative-link maximum likelihood by Adam over sparse features (row, column, value).

    Thresholds are the first one and positive steps, so they stay in order."""
    n = len(y)
    used, cols = np.unique(cols, return_inverse=True)
    p = np.zeros(len(used) + grades - 1)
    share = np.array([(y > k).mean() for k in range(grades - 1)]) if n else np.full(grades - 1, 0.5)
    start = -np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    p[len(used)] = start[0]
    p[len(used) + 1 :] = np.log(np.maximum(np.diff(start), 0.05))
    m, v = np.zeros_like(p), np.zeros_like(p)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    for step in range(1, steps + 1 if n else 1):
        w, raw = p[: len(used)], p[len(used) :]
        t = np.concatenate([[-np.inf], raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))]), [np.inf]])
        f = np.bincount(rows, weights=vals * w[cols], minlength=n)
        hi, lo = sig(t[y + 1] - f), sig(t[y] - f)
        prob = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / prob / n, lo * (1 - lo) / prob / n
        g = np.zeros_like(p)
        g[: len(used)] = np.bincount(cols, weights=vals * (d_hi - d_lo)[rows], minlength=len(used)) + ridge * w
        d_t = np.array([d_lo[y == k + 1].sum() - d_hi[y == k].sum() for k in range(grades - 1)])
        g[len(used)] = d_t.sum()
        for k in range(1, grades - 1):
            g[len(used) + k] = d_t[k:].sum() * np.exp(raw[k])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIMENSIONS)
    weights[used] = p[: len(used)]
    raw = p[len(used) :]
    return Ordinal(weights, raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))]))


def train(docs: DataFrame, labels: DataFrame, grade: str = GRADES, grades: int = 3, rows: int = SAMPLE, where: F.Column | None = None) -> Ordinal:
    """Fits on at most `rows` labelled documents; tasks make the features, the driver gets these alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            cols, vals = [], []
            for text in b["text"].to_pylist():
                words, shape = features(text)
                c, n = np.unique(np.array(words, np.int64), return_counts=True)
                cols.append([*c.tolist(), *shape])
                vals.append([*(WORDS * n / max(1, len(words))).tolist(), *[1.0] * len(shape)])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["y"], pa.array(cols, pa.list_(pa.int32())), pa.array(vals, pa.list_(pa.float32()))], names=["doc_id", "y", "cols", "vals"])

    got = sample(docs, labels, F.expr(grade).cast("int"), rows, where).mapInArrow(run, "doc_id long, y int, cols array<int>, vals array<float>").toArrow().sort_by("doc_id")
    sizes = np.array([len(x) for x in got["cols"]], np.int64)
    flat = lambda c, kind: np.concatenate([np.zeros(0, kind), *[k.flatten().to_numpy(zero_copy_only=False) for k in got[c].chunks]]).astype(kind)
    return fit(np.repeat(np.arange(len(sizes)), sizes), flat("cols", np.int64), flat("vals", np.float64), got["y"].to_numpy().astype(np.int64), grades)


def grade_documents(docs: DataFrame, model: Ordinal, at_least: int = 1, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, expected_grade, tail (P(grade >= k) for k = 1, 2, ...), keep (tail of at_least >= threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            tails = shared.value.tails(np.array([shared.value.f(t) for t in b["text"].to_pylist()], float))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64())), pa.array(tails[:, at_least - 1] >= threshold)], names=["doc_id", "expected_grade", "tail", "keep"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, expected_grade double, tail array<double>, keep boolean")
