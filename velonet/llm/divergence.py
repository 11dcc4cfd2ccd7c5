"""Source divergence audit: how far the terms of each (lang, source) group are from its language's and from other sources'.

Terms are runs of letters a-z (A-Z lower-cased) and of all code points past ASCII. A language keeps those in at least LEAST_DOCS of its
documents. A group gives each kept term the probability 1 + floor(SCALE * (count + 2) / (N + 2 * V)); so does a language. The
divergence of two is f = floor((p - q) ** 2 / (p + q)), in whole numbers throughout.

Part `term`, by upper-bound search: a group's postings lie in buckets by count, and each bucket's greatest p and least q bound the f
of its terms, as f grows with p and falls with q where p > q. Buckets are evaluated best first, each round twice as many; a group
stops once its next bound is strictly below its k-th value, so that ties at the k-th rank are all seen.

Part `pair`, by postings: groups meet at the terms that both have. What one group alone has depends on its count and on the other's
probability of absent terms only, so it comes from a histogram of counts, and what neither has is one product.

Counting: texts are counted in their tasks, bounded by HELD entries, and dealt by term once; document counts of a language are sums
over its sources. A hot source is as many rows as it has terms. The loop's tables are written to the shared folder.

Defined cases: null text, lang or source is ''; empty texts give their group no terms, and it still has its rows in part `pair`; a
language without kept terms has values of 0 there; repeated rows count as often as they occur; very long texts are counted by pieces; ids and
other columns, whatever their names, aren't read. Values that tie are ranked by the item's UTF-8 bytes. Empty in, empty out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velonet.llm.common import by_size
from velonet.operators.scratch import discard, written

LEAST_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
#: Entries that a task holds before it gives them on, and bytes of a text that are counted at once.
HELD, PIECE = 1 << 18, 1 << 20
#: A-Z in lower case, all else in ASCII but a-z blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, PIECE bytes or a single term at a time."""
    text, at = text.translate(_LETTERS), 0
    while len(text) - at > PIECE:
        end = text.rfind(b" ", at, at + PIECE)
        end = end if end >= 0 else text.find(b" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end].split()
        at = end + 1
    yield text[at:].split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            n, terms = len(times), list(times)
            cols = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(terms, pa.binary()), pa.array(list(times.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "count", "docs"])
        held.clear()

    for b in by_size(batches):
        for lang, source, text in zip(b["lang"].to_pylist(), b["source"].to_pylist(), b["text"].to_pylist(), strict=True):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for terms in _pieces(text):
                times.update(terms)
                own.update(terms)
            docs.update(own)
        if sum(len(t) for t, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


def _named(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and documents of the group that have the term."""
    rows = docs.select(*_named(docs), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    part = rows.mapInArrow(_count, "lang string, source string, term binary, count long, docs long").withColumn("term", F.col("term").cast("string"))
    # dealt by term: the sums here and those of a language need no other shuffle
    return part.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def probability(count: Column, n: Column, v: Column) -> Column:
    """Of a term, in a group with n occurrences of v kept terms. Decimals, since SCALE * count may pass a long."""
    share = F.call_function("div", (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), (n + 2 * v).cast("decimal(20,0)"))
    return F.when(v > 0, share + 1)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """The rows of count_terms() whose term its language keeps, with its occurrences there as `total`."""
    whole = Window.partitionBy("lang", "term")
    rows = counts.withColumns({"total": F.sum("count").over(whole), "in_docs": F.sum("docs").over(whole), "first": F.min("source").over(whole)})
    return rows.where(F.col("in_docs") >= least_docs).select("lang", "source", "term", "count", "total", (F.col("source") == F.col("first")).alias("first"))


def group_sums(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n, v, lang_n, zero) of every group that occurs: zero is the probability of a kept term that the group lacks."""
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    lang = kept.where("first").groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    every = docs.select(*_named(docs)).distinct().join(own, ["lang", "source"], "left").join(lang, "lang", "left")
    every = every.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")])
    return every.withColumn("zero", probability(F.lit(0), F.col("n"), F.col("v")))


def _best(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def bucket(count: Column) -> Column:
    """Counts to 16 have a bucket of their own, larger ones share it with those of the same 8th of a doubling."""
    return F.when(count <= 16, count).otherwise(F.floor(F.log2(count) * 8)).cast("int")


def top_terms(postings: DataFrame, top: int = TOP, first_round: int = 4) -> DataFrame:
    """(lang, source, item, value, rank): the `top` terms of each group with p > q by divergence.

    postings: lang, source, term, p, q, bucket, of terms that the group has."""
    sums = postings.groupBy("lang", "source", "bucket").agg(F.max("p").alias("p"), F.min("q").alias("q")).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("bound"), "bucket")
    bounds = written(sums.withColumn("bound", divergence(F.col("p"), F.col("q"))).withColumn("at", F.row_number().over(order)).select("lang", "source", "bucket", "bound", "at"), "bounds")
    found, seen, now = None, 0, bounds.where(F.col("at") <= first_round)
    while True:
        new = postings.where("p > q").join(now.select("lang", "source", "bucket"), ["lang", "source", "bucket"]).select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        old, found = found, written(_best(new if found is None else found.drop("rank").unionByName(new), top), "found")
        if old is not None:
            discard(old)
        seen, first_round = seen + first_round, 2 * first_round
        kth = found.where(F.col("rank") == top).select("lang", "source", F.col("value").alias("kth"))
        # bounds fall from one bucket to the next, so a group whose next one is strictly below its k-th value gives none
        now = bounds.where(F.col("at").between(seen + 1, seen + first_round)).join(kth, ["lang", "source"], "left").where(F.col("kth").isNull() | (F.col("bound") >= F.col("kth")))
        if now.isEmpty():
            discard(bounds)
            return found


def pair_values(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) of each group and each other source of its language.

    postings: lang, source, term, p, zero. groups: as group_sums()."""
    g = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("z"))
    times = postings.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("times"))
    alone = times.join(g, "lang").where("source <> other").groupBy("lang", "source", "other").agg(F.sum(F.col("times") * (divergence(F.col("p"), F.col("z")) - divergence(F.col("zero"), F.col("z")))).alias("value"))
    neither = groups.join(g, "lang").where("source <> other").select("lang", "source", "other", F.coalesce(F.col("v") * divergence(F.col("zero"), F.col("z")), F.lit(0)).alias("value"))
    a = postings.select("lang", "term", "source", "p", "zero")
    b = postings.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("r"), F.col("zero").alias("z"))
    p, z, r, y = (F.col(c) for c in ("p", "zero", "r", "z"))
    both = a.join(b, ["lang", "term"]).where("source < other").groupBy("lang", "source", "other").agg(F.sum(divergence(p, r) - divergence(p, y) - divergence(z, r) + divergence(z, y)).alias("value"))
    # f is the same both ways
    turned = lambda d: d.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    both, out = written(both, "both"), alone.unionByName(turned(alone)).unionByName(neither)
    every = out.unionByName(both).unionByName(turned(both)).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    return every.select("lang", "source", F.col("other").alias("item"), "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's `top` terms and all other sources of its language, by divergence."""
    kept = written(kept_terms(count_terms(docs), least_docs), "kept")
    groups = written(group_sums(docs, kept), "groups")
    with_sums = kept.join(groups, ["lang", "source"])
    p, q = probability(F.col("count"), F.col("n"), F.col("v")), probability(F.col("total"), F.col("lang_n"), F.col("v"))
    postings = written(with_sums.select("lang", "source", "term", p.alias("p"), q.alias("q"), "zero", bucket(F.col("count")).alias("bucket")), "postings")
    discard(kept)
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(top_terms(postings, top), "term").unionByName(part(pair_values(postings, groups), "pair"))
