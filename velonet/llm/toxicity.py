"""Toxicity: Levenshtein automata over a lexicon trie, and context windows that part quotation from abuse.

The lexicon (whole words and word stems) is learned from labelled rows: terms that occur in toxic documents far more often
than chance allows, and hardly elsewhere. It is kept as a trie; the automata of all its terms run as one, determinised
while it reads: a state is a set of (trie node, edits), so a word costs one step a letter, whatever the lexicon's size.
Words of FUZZY letters or more also match with one edit; stems match exactly, at the start of a word. Digits and marks that
stand for letters (idi0t, tr@sh) belong to a word if letters are on both sides of them.

Each match is looked at within WINDOW words: between quotation marks, or near them, it counts as quoted. A small logistic
regression turns a document's matches into a score. Everything is learned from at most SAMPLE labelled rows, by a
hash of the id; ids, languages and sources are never inputs. Every term that passes the test is kept, however long and however
many: each has documents of its own in the sample, whose size bounds them. Scores cover every row where it is, without a shuffle.

Defined cases: null and empty texts have no words and get the score of a text without matches; unlabelled rows are scored
alike; without labels (or of one kind only) nothing matches and the score is the share of toxic labels, 0 if there are none;
of several labels of an id the least counts; repeated rows give a row each; very long texts and words are read whole; other
columns, whatever their names, aren't read, and pass reject_toxic() as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, texts
from velonet.llm.labelled import sample

#: Labelled rows that lexicon and regression are learned from; states kept at a time.
SAMPLE, STATES = 16_000, 10_000
STEMS, FUZZY, WINDOW, THRESHOLD = range(4, 8), 5, 6, 0.3
#: Held out from learning: rows whose crc32(doc_id as text) has this remainder by 4.
HELD_OUT = 2
_SIGNS = b"0123456789@$!*"
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or c in _SIGNS else 34 if c in (34, 96) else 32 for c in range(256))
_ANY_SIGN = re.compile(rb"[0-9@$!*]")
#: Signs that don't have a letter before and after them.
_LOOSE = re.compile(rb"(?<![a-z\x80-\xff])[0-9@$!*]+|(?<=[a-z\x80-\xff])[0-9@$!*]+(?![0-9@$!*a-z\x80-\xff])")
_QUOTES = (b"\xe2\x80\x9c", b"\xe2\x80\x9d", b"\xe2\x80\x9e", b"\xc2\xab", b"\xc2\xbb", b"\xe2\x80\x98", b"\xe2\x80\x99")


def words(text: str) -> list[bytes]:
    """Runs of letters, and of signs between letters, A-Z lower-cased; a quotation mark is a word of its own."""
    b = text.encode()
    if b"\xe2\x80" in b or b"\xc2" in b:
        for q in _QUOTES:
            b = b.replace(q, b'"')
    b = b.translate(_LETTERS)
    if _ANY_SIGN.search(b):
        b = _LOOSE.sub(b" ", b)
    return (b.replace(b'"', b' " ') if b'"' in b else b).split()


class Lexicon:
    """terms: term -> whether it is a stem. find(word): (term, edits) or None."""

    def __init__(self, terms: dict[str, bool]):
        self.terms = dict(terms)
        self.trie: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[str, bool]] = {}
        for term, stem in terms.items():
            node = 0
            for c in term:
                if c not in self.trie[node]:
                    self.trie.append({})
                    self.trie[node][c] = len(self.trie) - 1
                node = self.trie[node][c]
            self.ends[node] = (term, stem)
        self.alphabet = {c for n in self.trie for c in n}
        self._build()

    def _build(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.done: list[tuple[str, int] | None] = []  # what a word matches that ends in the state
        self.stem: list[tuple[str, int] | None] = []  # what any word matches that reaches it
        self.words: dict[bytes, tuple[str, int] | None] = {}
        self.first = self._state({(0, 0)})

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("terms", "trie", "ends", "alphabet")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._build()

    def _state(self, some: set[tuple[int, int]]) -> int:
        """The number of a state; a letter of a term may be left out at an edit."""
        some |= {(child, 1) for node, edits in some if not edits for child in self.trie[node].values()}
        key = frozenset(x for x in some if not (x[1] and (x[0], 0) in some))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            hits = sorted((edits, *self.ends[node]) for node, edits in key if node in self.ends)
            self.done.append(next(((t, e) for e, t, stem in hits if not e or not stem and len(t) >= FUZZY), None))
            self.stem.append(next(((t, 0) for e, t, stem in hits if stem and not e), None))
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        """-1: nothing can match any more."""
        to = set()
        for node, edits in self.sets[state]:
            if c in self.trie[node]:
                to.add((self.trie[node][c], edits))
            if not edits:
                to.add((node, 1))
                to.update((child, 1) for child in self.trie[node].values())
        self.steps[state][c] = out = self._state(to) if to else -1
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        if len(self.sets) > STATES:
            self._build()  # states are made again when they are met; this bounds their memory
        state = self.first
        for c in word:
            c = c if c in self.alphabet else ""
            state = self.steps[state][c] if c in self.steps[state] else self._step(state, c)
            if state < 0:
                return None
            if self.stem[state]:
                return self.stem[state]
        return self.done[state]

    def find(self, word: bytes) -> tuple[str, int] | None:
        if word not in self.words:
            if len(self.words) > 400_000:
                self.words.clear()
            self.words[word] = self.match(word.decode(errors="replace"))
        return self.words[word]


def features(text: str, lexicon: Lexicon) -> list[float]:
    """1, and by logarithm: exact matches outside quotations, quoted ones, misspelt ones, different terms, matches a 100 words."""
    w = words(text)
    known = lexicon.words
    hits = [(i, h) for i, x in enumerate(w) if (h := known[x] if x in known else lexicon.find(x))]
    if not hits:
        return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    plain = quoted = bent = 0
    for i, (_, edits) in hits:
        before, after = w[max(0, i - WINDOW) : i], w[i + 1 : i + 1 + WINDOW]
        if b'"' in before and b'"' in after:
            quoted += 1
        elif edits:
            bent += 1
        else:
            plain += 1
    return [1.0, *map(math.log1p, (plain, quoted, bent, len({t for _, (t, _) in hits}), 100 * len(hits) / len(w)))]


def one_of_each(rows: DataFrame, shingle: int = 5) -> DataFrame:
    """One row for each least hash of the texts' word shingles: near copies mostly share theirs, and are one witness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            least = []
            for t in b["text"].to_pylist():
                w = words(t)
                least.append(min((zlib.crc32(b" ".join(w[k : k + shingle])) for k in range(max(1, len(w) - shingle + 1))), default=0))
            yield pa.RecordBatch.from_arrays([b["text"], b["y"], pa.array(least, pa.int64())], names=["text", "y", "least"])

    return rows.select("text", "y").mapInArrow(run, "text string, y int, least long").dropDuplicates(["least", "y"])


def learn_lexicon(rows: DataFrame) -> dict[str, bool]:
    """rows (text, y) -> term -> whether it is a stem.

    A term stays if nine tenths of its documents are toxic and the likelihood ratio against chance beats the number of
    terms tried; a term that a kept stem begins is left out, and a stem that only one word has is that word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            n: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, y in zip(b["text"].to_pylist(), b["y"].to_pylist(), strict=True):
                own = {x.decode(errors="replace") for x in set(words(text))}
                n[y].update({f"{x}$" for x in own if x != '"'})
                n[y].update({x[:k] for x in own for k in STEMS if len(x) > k})
            keys = list(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([n[0][k] for k in keys], pa.int64()), pa.array([n[1][k] for k in keys], pa.int64())], names=["term", "n0", "n1"])

    rows = one_of_each(rows)
    docs = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n0, n1 = docs.get(0, 0), docs.get(1, 0)
    if not n0 or not n1:
        return {}
    share = n1 / (n0 + n1)
    counts = rows.select("text", "y").mapInArrow(run, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    surprise = F.expr(f"n1 * ln(greatest(n1, 0.5) / (n0 + n1) / {share!r}) + n0 * ln(greatest(n0, 0.5) / (n0 + n1) / {1 - share!r})")
    got = counts.where("n1 >= 3 and n1 >= 9 * n0").withColumn("surprise", surprise).where(F.col("surprise") > math.log(1e6)).orderBy(F.desc("surprise"), "term").collect()  # of the sample's words those that tell
    stems = {r.term: r.n1 for r in got if not r.term.endswith("$")}
    whole = {r.term[:-1]: r.n1 for r in got if r.term.endswith("$")}
    best = Counter()  # of each beginning, the documents of the word that has most
    for w, n in whole.items():
        for k in STEMS:
            best[w[:k]] = max(best[w[:k]], n)
    kept: dict[str, bool] = {}
    for s in sorted(stems, key=len):
        if best[s] < 0.9 * stems[s] and not any(s[:k] in kept for k in STEMS):
            kept[s] = True
    return kept | {w: False for w in whole if not any(w[:k] in kept for k in STEMS)}


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(features(text, self.lexicon), self.weights), -30, 30))))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """Lexicon and regression from at most `rows` rows that aren't held out; the driver gets counts of terms and six numbers a row."""
    own = sample(docs, labels, F.col("toxic").cast("int"), rows, held_out(F.col("doc_id")) == F.lit(False)).where("y in (0, 1)").repartition(12).persist()
    try:
        lexicon = Lexicon(learn_lexicon(own))
        shared = docs.sparkSession.sparkContext.broadcast(lexicon)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in by_size(batches):
                x = [features(t, shared.value) for t in b["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([b["doc_id"], b["y"], pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

        got = own.mapInArrow(run, "doc_id long, y int, x array<double>").toArrow().sort_by("doc_id")
    finally:
        own.unpersist()
    y = got["y"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-12), 1 - 1e-12)
        return Model(lexicon, np.array([math.log(share / (1 - share)), 0, 0, 0, 0, 0]))
    return Model(lexicon, fit(np.array(got["x"].to_pylist(), float), y))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([shared.value.score(t) for t in b["text"].to_pylist()], pa.float64())], names=["doc_id", "score"])

    scored = texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score reaches the threshold; the rest as it is, where it is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            yield b.filter(pa.array([shared.value.score(t or "") < threshold for t in b["text"].to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
