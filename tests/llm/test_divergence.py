"""The source divergence audit against a plain version, in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from velonet.llm import divergence
from velonet.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, lang string, source string, term string, p long, item string"
TERM = re.compile(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least_docs, top):
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(AZ))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {k[0] for k in count}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        v, groups = len(kept), {k[1]: c for k, c in count.items() if k[0] == lang}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * v) for t in kept}  # noqa: E731, B023
        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s, c in groups.items():
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out |= {(lang, s, part, i, x, n + 1) for n, (x, i) in enumerate(sorted(items, key=lambda y: (-y[0], y[1].encode()))[:most])}
    return out


def audit(spark, rows, least_docs=2, top=3):
    docs = spark.createDataFrame([(i, t, lang, s, "x", 1, "y") for i, (t, lang, s) in enumerate(rows)], SCHEMA).repartition(3)
    got = [tuple(r) for r in divergence.audit(docs, least_docs, top).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed", range(3))
def test_as_plain(spark, seed):
    """Few distinct counts, so many ties; one source holds a third of the rows."""
    r = random.Random(seed)
    words = [f"w{c}" for c in "abcdefghijklmnop"] + ["Ünï", "中文", "Z", "\U0001f600x"]
    rows = [(" ".join(r.choices(words, k=r.randint(0, 30))), r.choice("ab"), "hot" if r.random() < 0.3 else r.choice("stuvw")) for _ in range(120)]
    assert audit(spark, rows) == plain(rows, 2, 3)


def test_odd_rows(spark):
    rows = [(None, "en", "a"), ("", "en", "b"), ("one One oNe 1one1 two", None, None), ("one two", "", ""), ("one two", "", ""), ("word " * 300000 + "end", "en", "b"), ("word end", "en", "c"), ("alone", "xx", "a"), ("other", "xx", "b"), ("only", "yy", "a")]
    got = audit(spark, rows)
    assert got == plain(rows, 2, 3)
    assert {x for x in got if x[0] == "xx"} == {("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)}  # no term is kept
    assert not {x for x in got if x[0] == "yy"}  # one source, no term


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).isEmpty()


@pytest.mark.parametrize("first", [1, 4])
def test_search_stops_only_below_the_kth(spark, first):
    """Ties over bucket limits, and groups that need very different numbers of rounds."""
    r = random.Random(first)
    rows = [("l", f"g{g}", f"t{i}", r.randint(1, 40) * 10**6, r.randint(1, 40) * 10**6) for g in range(4) for i in range(3 * 4**g)]
    rows += [("l", "ties", f"t{i}", 9 * 10**6, 10**6) for i in range(30)]
    postings = spark.createDataFrame(rows, "lang string, source string, term string, p long, q long").withColumn("bucket", (F.crc32(F.col("term").cast("binary")) % 7).cast("int"))
    got = {(x.source, x["item"], x.value, x["rank"]) for x in divergence.top_terms(postings, 5, first).collect()}
    want = set()
    for g in {x[1] for x in rows}:
        own = sorted((-((p - q) ** 2 // (p + q)), t) for _, s, t, p, q in rows if s == g and p > q)
        want |= {(g, t, -v, n + 1) for n, (v, t) in enumerate(own[:5])}
    assert got == want


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = b"ab cd-EFG " + b"x" * 30 + b" \xc3\xbcn y"
    assert [t for p in divergence._pieces(text) for t in p] == [b"ab", b"cd", b"efg", b"x" * 30, b"\xc3\xbcn", b"y"]


def test_counts_past_a_long(spark):
    row = spark.range(1).select(divergence.probability(F.lit(2 * 10**10), F.lit(3 * 10**10), F.lit(5)).alias("p"))
    assert row.first().p == 1 + 10**9 * (2 * 10**10 + 2) // (3 * 10**10 + 10)


def test_query_matches_sql(spark):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    key = lambda t: sorted(tuple(str(r[c]) for c in sorted(t.schema.names)) for r in t.to_pylist())
    name = "op13_source_divergence"
    assert key(QUERIES[name](spark, sf).toArrow()) == key(con.sql(SQL[name]).to_arrow_table())
