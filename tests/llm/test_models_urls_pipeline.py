"""Language-model scores, quality, toxicity, URL filters, the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from velonet.llm import lm_score, quality, toxicity, urls
from velonet.llm.tokens import Encoder, default_path


def plain_scores(rows, targets):
    """Every row by models that are counted anew without it."""
    e = Encoder(default_path())
    ids = [e.tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    grams = [list(zip([lm_score.START, *x], x, strict=False)) for x in ids]
    size = len({b for x in grams for _, b in x})

    def model(use):
        c = Counter(g for g, u in zip(grams, use, strict=True) if u for g in g)
        v, w, kinds = Counter(), Counter(), Counter()
        for (a, b), n in c.items():
            v[a] += n
            w[b] += n
            kinds[a] += 1
        total = sum(w.values())
        uni = lambda b: (w[b] + 1) / (total + size)
        return lambda a, b: math.log((max(c[a, b] - 0.75, 0) + 0.75 * kinds[a] * uni(b)) / v[a] if v[a] else uni(b))

    out = []
    for k, ((i, _), x, g) in enumerate(zip(rows, ids, grams, strict=True)):
        back, target = (model([j != k and (i in targets) == t for j, (i, _) in enumerate(rows)]) for t in (False, True))
        out.append((i, len(x), sum(back(a, b) - target(a, b) for a, b in g) / len(g) if g else 0.0))
    return out


@pytest.mark.parametrize("limit", [10**6, 0])
def test_lm_scores(spark, docs, odd, labels, limit):
    r = random.Random(1)
    rows = [*odd, *[(10 + k, " ".join(r.choice(["red", "green", "blue", "Berlin"]) for _ in range(r.randint(1, 30)))) for k in range(30)]]
    targets = {i for i in range(40) if i % 2 == 1}
    got = lm_score.cross_entropy_difference(docs(rows), labels, broadcast_rows=limit).collect()
    want = plain_scores(rows, targets)
    assert sorted((str(x.doc_id), x.n_tokens, round(x.score, 6)) for x in got) == sorted((str(i), n, round(s, 6)) for i, n, s in want)
    assert lm_score.cross_entropy_difference(docs([]), labels).count() == 0
    assert all(np.isfinite(x.score) for x in lm_score.cross_entropy_difference(docs(rows), labels.where("doc_id < 0")).collect())


def test_lm_scores_are_the_same_by_both_ways(spark, docs, labels):
    r = random.Random(6)
    rows = [(k, " ".join(r.choice(["red", "green", "blue", "Berlin"]) for _ in range(r.randint(1, 30)))) for k in range(40)]
    a, b = ({x.doc_id: x.score for x in lm_score.cross_entropy_difference(docs(rows), labels, broadcast_rows=n).collect()} for n in (10**6, 0))
    assert a.keys() == b.keys() and any(a.values()) and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_ordinal_fit_recovers_order():
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 4))
    f = x @ np.array([2.0, -1.0, 0.5, 0.0])
    y = (f + r.logistic(size=600) > -1).astype(int) + (f + r.logistic(size=600) > 2)
    rows, cols = np.repeat(np.arange(600), 4), np.tile(np.arange(4), 600)
    m = quality.fit(rows, cols, x.ravel(), y, 3, steps=400)
    assert m.thresholds[0] < m.thresholds[1] and m.weights[0] > 1 > -0.3 > m.weights[1]
    tails = m.tails(x @ m.weights[:4])
    assert (tails[:, 0] >= tails[:, 1]).all() and np.corrcoef(tails.sum(axis=1), y)[0, 1] > 0.6


def test_quality_odd(spark, docs, odd, labels):
    rows = [*odd, *[(10 + k, ("good plain words here. " if k % 2 else "BAD!! BAD!! || ") * 10) for k in range(30)]]
    m = quality.train(docs(rows), labels)
    got = quality.grade_documents(docs(rows), m).collect()
    assert len(got) == len(rows) and all(0 <= x.expected_grade <= 2 and 1 >= x.tail[0] >= x.tail[1] >= 0 for x in got)
    assert all(x.keep == bool(x.doc_id % 2) for x in got if x.doc_id and x.doc_id >= 10)
    none = quality.train(docs(rows), labels.where("doc_id < 0"))
    assert not none.weights.any() and quality.grade_documents(docs(odd), none).count() == len(odd)
    assert quality.grade_documents(docs([]), m).count() == 0


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    m = quality.train(docs, labels, where=~toxicity.held_out(F.col("doc_id")))
    got = quality.grade_documents(docs, m).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    assert got.select(F.avg((F.col("keep") == (F.col("quality") == 1)).cast("int"))).first()[0] > 0.95


def edits(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        d, last = [i], d
        for j, y in enumerate(b, 1):
            d.append(min(last[j] + 1, d[-1] + 1, last[j - 1] + (x != y)))
    return d[-1]


def test_automaton_is_levenshtein():
    terms = {"idiot": False, "moron": False, "trash": False, "scum": False, "abcab": False, "vequ": True}
    lex = toxicity.Lexicon(terms)
    r = random.Random(2)
    for _ in range(3000):
        w = list(r.choice([*terms, "idiots", "oron", "vequtá"]))
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(w) + 1)
            w[k : k + r.randint(0, 1)] = r.choice(["", "i", "z", "á"])
        w = "".join(w)
        got = lex.match(w)
        if w.startswith("vequ"):
            assert got == ("vequ", 0)
            continue
        best = min((edits(w, t), t) for t, stem in terms.items() if not stem)
        ok = best[0] == 0 or best[0] == 1 and any(edits(w, t) == 1 and len(t) >= 5 for t, stem in terms.items() if not stem)
        assert bool(got) == ok, (w, got, best)
        if got:
            assert got[1] == best[0] or got[1] == 1


def test_quotation_counts_apart():
    lex = toxicity.Lexicon({"idiot": False})
    f = lambda t: toxicity.features(t, lex)[1:4]
    assert f("you idiot there")[0] > 0 and f("you idiot there")[1] == 0
    assert f('he wrote “idiot” there')[1] > 0 and f('he wrote "idiot" there')[0] == 0
    assert f("you idi0t")[2] > 0 and f("you idiott")[2] > 0 and f("an 1d!ot, Idiot! idiot5 5 !!")[0] > 0
    assert toxicity.words("you idi0t! tr@sh 3rd a1b2 9 c3") == [b"you", b"idi0t", b"tr@sh", b"rd", b"a1b", b"c"]


def test_toxicity_scores_as_plain_ones(spark, docs, odd):
    """The query's scores from a model by plain means: each word against each term, by edit distance."""
    terms = {"idiot": False, "moron": False, "scum": False, "vequ": True}
    m = toxicity.Model(toxicity.Lexicon(terms), np.array([-3.0, 2.0, 0.4, 1.5, 0.3, 0.2]))

    def plain(text):
        t = "".join('"' if c in "“”„«»‘’`" else c for c in text).translate({c: c + 32 for c in range(65, 91)})
        t = "".join(c if c in '"0123456789@$!*' or "a" <= c <= "z" or ord(c) > 127 else " " for c in t).replace('"', ' " ')
        letter = lambda c: "a" <= c <= "z" or ord(c) > 127
        out, k = [], 0
        t = f" {t} "
        while k < len(t):  # runs of signs stay between letters only
            e = k
            while e < len(t) and t[e] in "0123456789@$!*":
                e += 1
            if e > k:
                out.append(t[k:e] if letter(t[k - 1]) and letter(t[e]) else " ")
            else:
                out.append(t[k])
                e = k + 1
            k = e
        w = "".join(out).split()
        n, kinds = [0, 0, 0], set()
        for i, x in enumerate(w):
            exact = next((s for s, stem in terms.items() if (x.startswith(s) if stem else x == s)), None)
            near = next((s for s, stem in sorted(terms.items()) if not stem and len(s) >= 5 and edits(x, s) == 1), None)
            if not (exact or near):
                continue
            kinds.add(exact or near)
            n[1 if '"' in w[max(0, i - 6) : i] and '"' in w[i + 1 : i + 7] else 0 if exact else 2] += 1
        if not sum(n):
            return 1 / (1 + math.exp(3))
        x = [1.0, *map(math.log1p, (*n, len(kinds), 100 * sum(n) / len(w)))]
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, m.weights, strict=True))))

    r = random.Random(12)
    parts = ["idiot", "Idi0t", "idot", "mor on", "m0r0n", "moro!n", "scum", "scvm", "vequxyz", "“", "”", '"', "tree", "house", "3", "!!", "é", "idiot5", "ïdiot"]
    rows = [*odd, *[(100 + k, " ".join(r.choice(parts) for _ in range(r.randint(1, 25)))) for k in range(150)]]
    got = toxicity.score_documents(docs(rows), m).collect()
    want = sorted((str(i), round(plain(t or ""), 9)) for i, t in rows)
    assert sorted((str(x.doc_id), round(x.score, 9)) for x in got) == want and len({s for _, s in want}) > 40
    assert all(x.predicted == int(x.score >= 0.3) for x in got)


def test_lexicon_has_no_caps(spark, docs):
    """Long words and very many terms are learned like others."""
    r = random.Random(15)
    word = lambda k: f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100]}bad"
    long = "verylongabusiveword" * 3
    rows = [(k, " ".join(["tree", "house", *(r.sample([word(j) for j in range(600)], 120) + [long, "zq"] if k % 3 == 0 else []), *r.choices([a + b + c for a in "bdfg" for b in "aeiou" for c in "lmnr"], k=30)])) for k in range(240)]
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k, _ in rows], "doc_id long, quality int, toxic int")
    m = toxicity.train(docs(rows), labels)
    hit = lambda w: m.lexicon.find(w.encode()) is not None
    assert sum(hit(word(j)) for j in range(600)) > 400 and hit(long) and hit("zq") and not hit("tree")


def test_sample_is_bounded_by_rows(spark, docs):
    from pyspark.sql import functions as F

    from velonet.llm.labelled import sample

    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    got = sample(docs([(1, "b"), (1, "a"), (1, None), (2, "x"), (2, "x"), (3, "c"), (None, "n")]), labels, F.col("toxic"), 5).collect()
    assert sorted(tuple(x) for x in got) == [(1, "", 0), (2, "x", 1)]


def test_quality_grades_as_plain_ones(spark, docs, odd):
    """The query's grades from a model's weights, word by word."""
    import zlib

    weights = np.random.default_rng(5).normal(size=quality.DIMENSIONS)
    m = quality.Ordinal(weights, np.array([-0.5, 0.8]))
    at = lambda t: weights[zlib.crc32(t.encode()) % quality.DIMENSIONS]

    def plain(text):
        w = text.split()
        n, chars, joined = max(1, len(w)), max(1, len(text)), "".join(w)
        bare = ["".join(c for c in x if c not in ".,;:!?\"'()").lower() for x in w]
        tenth = {
            "capitals": sum(x.isupper() for x in w) / n,
            "letters": sum(x.isalpha() for x in w) / n,
            "repeats": sum(w[k] == w[k + 1] for k in range(len(w) - 1)) / n,
            "distinct": len(set(w)) / n,
            "bars": 5 * text.count("|") / chars,
            "marks": 5 * sum(c in "#$%&*!@" for c in joined) / chars,
            "digits": 2 * sum(c in "0123456789" for c in joined) / chars,
            "lines": 10 * text.count("\n") / chars,
            "length": min(1.0, math.floor(math.log2(len(text)) + 1) / 20 if text else 0),
            "word": min(1.0, len(joined) / n / 20),
        }
        f = sum(at(f"shape {k} {min(10, int(10 * v))}") for k, v in tenth.items()) + (8 * sum(map(at, bare)) / len(w) if w else 0)
        return [1 / (1 + math.exp(t - f)) for t in m.thresholds]

    r = random.Random(14)
    rows = [*odd, *[(100 + k, " ".join(r.choice(["Good", "good.", "BAD!!", "|", "12", "x\ny", "plain"]) for _ in range(r.randint(1, 30)))) for k in range(60)]]
    got = quality.grade_documents(docs(rows), m).collect()
    want = sorted(((str(i), *[round(x, 9) for x in plain(t or "")]) for i, t in rows), key=str)
    assert sorted(((str(x.doc_id), *[round(v, 9) for v in x.tail]) for x in got), key=str) == want
    assert all(abs(x.expected_grade - sum(x.tail)) < 1e-12 and x.keep == (x.tail[0] >= 0.5) for x in got)


def test_toxicity_odd(spark, docs, odd):
    r = random.Random(5)
    rows, lab = [], []
    for k in range(300):
        bad = k % 4 == 0
        rows.append((k, " ".join(r.choice(["tree", "house", "river", "stone"]) for _ in range(30)) + (" scumbag Scumbag! fool" if bad else "")))
        lab.append((k, 1, int(bad)))
    labels = spark.createDataFrame([*lab, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    m = toxicity.train(docs(rows), labels)
    assert set(m.lexicon.terms) >= {"fool"} and any(t.startswith("scum") for t in m.lexicon.terms)
    got = toxicity.score_documents(docs([*rows, *[(1000 + (i or 0), t) for i, t in odd], (2000, "you sc umbag scumbaag fools")]), m).collect()
    assert len(got) == len(rows) + len(odd) + 1 and all(0 <= x.score <= 1 for x in got)
    assert all(x.predicted == int(x.doc_id % 4 == 0) for x in got if x.doc_id < 300)
    assert {x.predicted for x in got if 1000 <= x.doc_id < 2000} == {0}
    kept = toxicity.reject_toxic(docs([*rows, *odd]), m)
    assert kept.count() == 225 + len(odd) and kept.columns == docs([]).columns
    none = toxicity.train(docs(rows), labels.where("doc_id < 0"))
    assert toxicity.score_documents(docs(odd), none).where("predicted = 1").count() == 0
    assert toxicity.score_documents(docs([]), m).count() == 0


def test_toxicity_held_out(spark):
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.score_documents(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out")
    n = {(x.toxic, x.predicted): x["count"] for x in got.groupBy("toxic", "predicted").count().collect()}
    assert n.get((1, 1), 0) / (n.get((1, 1), 0) + n.get((1, 0), 0)) > 0.8 and n.get((0, 1), 0) / n[0, 0] < 0.02
    assert got.agg(F.min("score"), F.max("score")).first()[0] >= 0


URLS = [
    ("https://WWW.Example.com/en/1?x=/fr/", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://notexample.com/en/2", "notexample.com", "/en/2", "com/", "allow"),
    ("http://x.net/es/5#/fr/", "x.net", "/es/5", "net/es/", "block"),
    ("http://x.net/es", "x.net", "/es", None, "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://example.com?u=://x.net/es/", "example.com", "", None, "allow"),
    ("x://y://net/es/1", "y:", "//net/es/1", None, "allow"),
    ("net/es/1", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://./en/", ".", "/en/", None, "allow"),
    ("ftp://m.net/fr/\n/x", "m.net", "/fr/\n/x", "net/fr/", "block"),
]


def test_urls(spark):
    df = spark.createDataFrame([(k, u[0], "h", "r") for k, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in urls.filter_urls(df).collect()}
    for k, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, verdict)
    assert urls.filter_urls(df.limit(0)).count() == 0


def test_urls_by_many_tries_as_by_one(spark):
    """Rules of any size give the same rows; equal rules, repeated rows, long urls and no rules at all."""
    r = random.Random(18)
    rules = [*urls.RULES, *[(r.choice(["allow", "block"]), f"{h}/{p}") for h in ("com", "a.com", "net", "x.net") for p in ("", "x", "x/", "x/y", "en/") for _ in range(2)]]
    pages = [(k % 50, f"http://{r.choice(['a.com', 'b.a.com', 'www.example.com', 'x.net', 'net'])}/{r.choice(['', 'x', 'x/y/z', 'en/1', 'es/'])}") for k in range(120)]
    pages += [(None, None), (7, "http://a.com/" + "x/" * 50000), (7, "http://a.com/" + "x/" * 50000)]
    df = spark.createDataFrame([(i, u, "z", 1) for i, u in pages], "page_id long, url string, verdict string, trie int")
    one, many, each = (sorted((tuple(x) for x in urls.filter_urls(df, rules, rule_bytes=n).collect()), key=str) for n in (1 << 30, 200, 1))
    assert one == many == each and len(one) == len(pages)
    for (i, host, path, rule, verdict) in one:
        fits = [(len(x), len(x.partition("/")[0]), k, v, x) for k, (v, x) in enumerate(rules) if (host == (h := x.partition("/")[0]) or host.endswith("." + h)) and path.startswith(x[len(h) :])]
        assert (rule, verdict) == (max(fits)[4], max(fits)[3]) if fits else (rule, verdict) == (None, "allow"), (i, host, path)
    assert {x.verdict for x in urls.filter_urls(df, [], "block").collect()} == {"block"}


def test_trie_is_longest_match():
    r = random.Random(8)
    hosts, paths = ["com", "a.com", "b.a.com", "net", "c.net"], ["/", "/x", "/x/", "/x/y", "/xy/", ""]
    for _ in range(300):
        rules = [(r.choice(["allow", "block"]), h + p) for h in hosts for p in paths if p and r.random() < 0.3]
        trie = urls.RuleTrie(rules)
        host, path = r.choice([*hosts, "d.c.net", "xcom", "org"]), r.choice(["", "/", "/x", "/x/", "/x/y", "/x/yz/", "/xy/1", "/xyz"])
        fits = [(len(x), len(x.partition("/")[0]), (v, x)) for v, x in rules if (host == (h := x.partition("/")[0]) or host.endswith("." + h)) and path.startswith(x[len(h) :])]
        want = max(fits)[2] if fits else None
        assert trie.find(host, path) == want


def test_pipeline_against_brute_force(spark):
    """Each stage's rows from the operators' plain forms, on the smallest tables."""
    import corpus_pipeline as p
    from tests.llm.test_dedup_decontam import plain_contamination, plain_similar
    from tests.llm.test_scan_pack_print import base, check_packing

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    now = docs
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, now, d)
        assert out.columns == docs.columns and out.schema == docs.schema
        before = {x.doc_id: x.text for x in now.collect()}
        after = {x.doc_id: x.text for x in out.collect()}
        if name == "toxicity":
            assert after == {i: t for i, t in before.items() if model.score(t) < 0.3}
        if name == "simhash_near_dedup":
            ids = sorted(before)
            comp = plain_similar([before[i] for i in ids])  # the stage's measure: five words, 0.8
            assert after == {i: before[i] for k, i in enumerate(ids) if comp[k] == k}
        if name == "decontamination":
            assert after == {i: before[i] for i, _, h, _ in plain_contamination(list(before.items()), items) if not h}
        if name == "secret_scan":
            assert after.keys() == before.keys() and all((after[i] == before[i]) == (not base(before[i])) and not base(after[i]) for i in after)
        now = out
    texts = {x.doc_id: x.text for x in now.collect()}
    rows = p.run(spark, d).collect()
    check_packing(rows, texts, 2048)
    assert {r.doc_id for r in rows} == set(texts)


def test_rest_imports_without_this_subpackage(tmp_path):
    """The library doesn't need the text operators."""
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "velonet", tmp_path / "velonet", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'edge_aggregate' in q and not [k for k in q if k.startswith('op1') or k == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
