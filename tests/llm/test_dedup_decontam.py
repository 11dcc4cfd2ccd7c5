"""Decontamination, substring dedup, SimHash near-duplicates, components."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from velonet.llm import decontam, simhash, similar, substring_dedup
from velonet.operators.graph import least_reachable

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(r, n, words=40):
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def plain_contamination(docs, items):
    wordsof = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = {}
    for i, t in items:
        w = wordsof(t)
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, who = wordsof(t), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                found = windows.get(tuple(w[k : k + m]))
                if found:
                    hit |= set(range(k, k + m))
                    who |= found
        out.append((i, len(w), len(hit), tuple(sorted(who))))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, docs, odd, block_bytes):
    r = random.Random(7)
    items = [(k, prose(r, r.randint(3, 25), 12)) for k in range(25)] + [(90, None), (91, "..."), (92, "ONE-two"), (92, "one TWO"), (93, "héllo wörld")]
    rows = [*odd, (20, "x Héllo; héllo WÖRLD y"), *[(100 + k, prose(r, 60, 12) + " " + r.choice(items[:25])[1] + ". " + prose(r, 30, 12)) for k in range(60)]]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_contamination(docs(rows), b, block_bytes=block_bytes)
    assert sorted(((x.doc_id, x.n_words, x.n_hit, tuple(x["items"])) for x in got.collect()), key=str) == plain_contamination(rows, items)
    kept = decontam.remove_contaminated(docs(rows), b, block_bytes=block_bytes)
    clean = [i for i, _, h, _ in plain_contamination(rows, items) if not h]
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted(clean, key=str) and kept.columns == docs(rows).columns


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_decontamination_by_items_without_an_id(spark, docs, block_bytes):
    r = random.Random(31)
    p, q = prose(r, 14, 900), prose(r, 14, 900)
    b = spark.createDataFrame([(None, p), (5, q), (None, q), (None, None)], "item_id long, text string")
    d = docs([(1, f"a b {p} c"), (2, f"a {q} b"), (3, "a b c"), (4, f"{p} {q}")])
    got = {x.doc_id: (x.n_hit, x.n_items, x["items"], x.contaminated) for x in decontam.find_contamination(d, b, block_bytes=block_bytes).collect()}
    assert got == {1: (14, 0, [], True), 2: (14, 1, ["5"], True), 3: (0, 0, [], False), 4: (28, 1, ["5"], True)}
    assert [x.doc_id for x in decontam.remove_contaminated(d, b, block_bytes=block_bytes).collect()] == [3]


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    """With a hash that hardly tells windows apart, verification alone decides."""
    monkeypatch.setattr(decontam, "roll", lambda columns: columns[0].astype(np.uint64) % np.uint64(3))
    r = random.Random(43)
    items = [(str(k % 9), prose(r, r.randint(2, 14), 5)) for k in range(60)] + [(None, prose(r, 12, 5))]
    tests = decontam.TestSet([(i, t.encode()) for i, t in items])
    texts = [prose(r, 200, 5) for _ in range(10)]
    got = [(k, c, len({x for s, e in hit for x in range(s, e)}), tuple(who)) for k, (c, hit, who) in enumerate(tests.hits([t.encode() for t in texts]))]
    named = {k: tuple(i for i in who if i != "None") for k, _, _, who in plain_contamination(list(enumerate(texts)), items)}
    assert sorted(got, key=str) == sorted(((k, c, h, named[k]) for k, c, h, _ in plain_contamination(list(enumerate(texts)), items)), key=str)


def test_decontamination_of_nothing(spark, docs, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_contamination(docs(odd), none).where("contaminated").count() == 0
    assert decontam.find_contamination(docs([]), none).count() == 0
    assert decontam.remove_contaminated(docs(odd), none).count() == len(odd)


def plain_repeats(docs):
    first = {}
    split = {k: (i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (i, t) in enumerate(docs)}
    num = lambda i: 2**63 if i is None else i
    for i, w in split.values():
        for p in range(len(w) - 12):
            g = tuple(w[p : p + 13])
            first[g] = min(first.get(g, 2**64), num(i))
    out = []
    for i, w in split.values():
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < num(i) for q in range(p, p + 13)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_dedup(spark, docs, odd):
    r = random.Random(11)
    shared = [prose(r, r.randint(11, 70), 500) for _ in range(8)]
    rows = list(odd)
    for k in range(150):
        parts = [prose(r, r.randint(0, 30), 500)] + [x for _ in range(r.randint(0, 3)) for x in (r.choice(shared), prose(r, r.randint(0, 20), 500))]
        rows.append((10 + k * 3 % 151, r.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(500 + k, shared[0]) for k in range(80)]  # a passage that a third of all share
    rows += [(700, "a b " * 40), (700, "a b " * 40), (None, shared[1]), (-5, shared[2])]
    got = substring_dedup.kept_digest(substring_dedup.remove_repeats(docs(rows))).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain_repeats(rows)
    assert substring_dedup.remove_repeats(docs([])).count() == 0
    with pytest.raises(ValueError, match="difference cover"):
        substring_dedup.remove_repeats(docs([]), cover=(0, 1))


def test_substring_dedup_of_words_that_polynomial_hashes_confuse(spark, docs):
    """The letters of the Thue-Morse sequence and their complement collide under every odd base modulo 2 ** 64."""
    a = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    b, rest = a.translate(str.maketrans("ab", "ba")), " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{rest} {a} {rest}")]
    got = substring_dedup.kept_digest(substring_dedup.remove_repeats(docs(rows))).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain_repeats(rows)
    assert {x.doc_id: x.n_removed for x in got} == {1: 0, 2: 0, 3: 13}


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 30])
def test_substring_dedup_in_chunks_of_any_size(spark, docs, chunk_bytes):
    """Ids that many rows share, equal rows and null ids, in one chunk a row and in one for all."""
    r = random.Random(41)
    p = [prose(r, 30, 300) for _ in range(4)]
    rows = [(i, f"{prose(r, 5, 300)} {r.choice(p)} {prose(r, r.randint(0, 5), 300)}") for i in [5] * 30 + [None] * 20 + [*range(1, 15)]]
    rows += [(2, p[0])] * 25
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = substring_dedup.kept_digest(substring_dedup.remove_repeats(docs(rows), chunk_bytes=chunk_bytes)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted((tuple(x) for x in got), key=str) == plain_repeats(rows)


def plain_fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    g = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_simhash(spark, docs, odd):
    r = random.Random(13)
    base = [prose(r, 300, 400) for _ in range(6)]
    rows = list(odd)
    for k in range(120):
        w = r.choice(base).split(" ")
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(["New", "other"])
        rows.append((1000 + k, " ".join(w)))
    rows += [(2000 + k, base[0]) for k in range(70)] + [(3000 + k, prose(r, 40)) for k in range(40)]
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = plain_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp, strict=True):
        least[c] = min(least.get(c, 2**63), 2**63 if i is None else i)
    want = sorted(((i, f"{f:016x}", None if least[c] == 2**63 else least[c]) for (i, _), f, c in zip(rows, fps, comp, strict=True)), key=str)
    got = [(x.doc_id, x.fingerprint, x.component_id) for x in simhash.near_duplicates(docs(rows)).collect()]
    assert sorted(got, key=str) == want
    kept = simhash.keep_one_each(docs(rows))
    assert {x.doc_id for x in kept.collect()} == {None if v == 2**63 else v for v in least.values()} and kept.columns == docs(rows).columns
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.keep_one_each(docs([])).count() == 0


def test_simhash_without_ids(spark, docs):
    """Null ids, and ids that several texts share, join nothing; each group keeps one row."""
    r = random.Random(29)
    a, b, c, d = (prose(r, 200, 900) for _ in range(4))
    near = lambda t: next(x for x in (t.replace(w, "other", 1) for w in t.split()) if (plain_fingerprint(x) ^ plain_fingerprint(t)).bit_count() in (1, 2))
    rows = [(None, a), (None, b), (None, c), (None, c), (None, near(c)), (7, near(a)), (9, near(b)), (3, d), (3, prose(r, 90, 900)), (3, d)]
    comp = plain_components([plain_fingerprint(t) for _, t in rows])
    least = {}
    for (i, _), k in zip(rows, comp, strict=True):
        least[k] = min(least.get(k, 2**63), 2**63 if i is None else i)
    got = [(x.doc_id, x.fingerprint, x.component_id) for x in simhash.near_duplicates(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(((i, f"{plain_fingerprint(t):016x}", None if least[k] == 2**63 else least[k]) for (i, t), k in zip(rows, comp, strict=True)), key=str)
    assert {x[2] for x in got if x[0] in (7, 9)} == {7, 9}
    kept = [(x.doc_id, x.text) for x in simhash.keep_one_each(docs(rows)).collect()]
    assert len(kept) == len(least) and {(7, near(a)), (9, near(b)), (3, d)} <= set(kept) and sum(i is None for i, _ in kept) == 1


def plain_similar(texts):
    """The place of the first text of each text's group."""
    sets, parent = [], list(range(len(texts)))
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 5 * len(x & y) >= 4 * len(x | y):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def test_near_copies_with_changed_words_go(spark, docs, odd):
    """The pipeline's stage: five-word similarity 0.8, however many bits the fingerprints differ in."""
    import corpus_pipeline

    r = random.Random(23)
    texts = [t for _, t in odd]
    for _ in range(15):
        base = prose(r, 120, 4000).split(" ")
        for _ in range(6):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = f"n{r.randrange(9999)}"
            texts.append(" ".join(w))
    base = prose(r, 150, 4000).split(" ")
    for k in range(60):  # more than a small bucket holds
        texts.append(" ".join([*base[:k], "changed", *base[k + 1 :]]))
    texts += ["q r s", "q  R s", "", " ", prose(r, 50, 4000)]
    first = plain_similar(texts)
    far = [(a, b) for a, b in zip(range(len(texts)), first, strict=True) if (plain_fingerprint(texts[a]) ^ plain_fingerprint(texts[b])).bit_count() > 2]
    assert len(far) > 20
    rows = [(10 + k, t) for k, t in enumerate(texts)]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs(rows), "")
    assert sorted(x.doc_id for x in kept.collect()) == sorted({10 + k for k in first}) and kept.columns == docs(rows).columns
    other = [(None, texts[0]), (None, texts[1]), (None, prose(r, 50, 4000)), (None, prose(r, 50, 4000)), (7, texts[-1]), (7, texts[-1]), (7, prose(r, 30, 4000))]
    got = [(x.doc_id, x.text) for x in similar.keep_one_each(docs(other)).collect()]
    assert sorted(got, key=str) == sorted({(None, next(t for i, t in got if i is None and not (t or "").split())), *[x for x in other if (x[1] or "").split()]}, key=str)
    assert similar.keep_one_each(docs([])).count() == 0


@pytest.mark.parametrize(("shared", "own", "n"), [(170, 20, 600), (60, 5, 500), (40, 5, 500), (300, 70, 300)])
def test_texts_about_a_shared_passage(spark, docs, shared, own, n):
    """Crowds whose pairs lie on both sides of the bound, in buckets that no least text joins: no link is lost."""
    r = random.Random(shared)
    base = prose(r, shared, 4000)
    texts = [" ".join([*prose(r, x := r.randint(0, own), 4000).split(" ")[:x], base, *prose(r, own - x + r.randint(0, 6), 4000).split(" ")]) for _ in range(n)]
    first = plain_similar(texts)
    kept = similar.keep_one_each(docs([(10 + k, t) for k, t in enumerate(texts)]))
    assert len(set(first)) > n / 10
    assert sorted(x.doc_id for x in kept.select("doc_id").collect()) == sorted({10 + k for k in first})


@pytest.mark.parametrize(("texts", "shingles"), [(2048, 1 << 20), (40, 1 << 20), (2048, 3000)])
def test_crowds_in_units(spark, monkeypatch, texts, shingles):
    """One bucket with a component of most texts and stragglers about the bound; its least fits nobody. Parts lose nothing."""
    monkeypatch.setattr(similar, "UNIT_TEXTS", texts)
    monkeypatch.setattr(similar, "UNIT_SHINGLES", shingles)
    r = np.random.default_rng(texts + shingles)
    core = r.integers(0, 1 << 62, 100, dtype=np.uint64)
    sets = [np.unique(r.integers(0, 1 << 62, 300, dtype=np.uint64)), *[np.unique(np.r_[core, r.integers(0, 1 << 62, int(k), dtype=np.uint64)]) for k in r.integers(0, 26, 150)], np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
    rows = spark.createDataFrame([(k, s.astype("<u8").tobytes()) for k, s in enumerate(sets)], "node long, s binary").withColumn("n", F.expr("length(s) div 8"))
    nodes = rows.select("node", "n", F.array(F.lit(5).cast("long")).alias("bands"))
    labelled = spark.createDataFrame([(k, 1) for k in range(2, 60)], "id long, component long")
    found = similar.crowd_links(similar.members(nodes), rows.select("node", "s"), labelled)
    parent = {k: 1 if 2 <= k < 60 else k for k in range(len(sets))}
    got = {x.id: x.component for x in least_reachable(found.unionByName(labelled.toDF("a", "b"))).collect()}

    def root(k):
        return k if parent[k] == k else root(parent[k])

    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    assert [got.get(k, k) for k in range(len(sets))] == [root(k) for k in range(len(sets))]
    assert found.count() < len(sets) * (1 if texts > 40 and shingles > 3000 else 30)


def test_a_long_text_among_similar_ones(spark, docs):
    r = random.Random(3)
    long = prose(r, 60000, 4000)
    rows = [(1, long), (2, long + " end"), (3, "start " + long), (4, prose(r, 60000, 4000)), (5, long[: len(long) // 2])]
    assert sorted(x.doc_id for x in similar.keep_one_each(docs(rows)).select("doc_id").collect()) == [1, 4, 5]


def in_gray_order(fps):
    rank = fps.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return fps[np.argsort(rank)]


def connected(fps, pairs):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        assert (a ^ b).bit_count() <= 2
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


def plain_connected(fps):
    least = {}
    for f, c in zip(fps, plain_components(fps), strict=True):
        least[c] = min(f, least.get(c, f))
    return {f: least[c] for f, c in zip(fps, plain_components(fps), strict=True)}


CROWDS = [(5, 3), (200, 8), (600, 10), (900, 21), (256, 8), (500, 40)]


def test_tree_links_as_brute_force(monkeypatch):
    """Crowds of every density through the tree, and through two trees; most pairs are pruned in groups."""
    r = np.random.default_rng(17)
    seen, meet = [0, 0], simhash.may_meet

    def counted(every, *rest):
        out = meet(every, *rest)
        seen[0] += len(out)
        seen[1] += int((~out).sum())
        return out

    monkeypatch.setattr(simhash, "may_meet", counted)
    for n, free in CROWDS:
        fps = in_gray_order(np.unique(r.integers(0, 1 << free, n, dtype=np.uint64) << np.uint64(20)))
        tree = simhash.Tree(fps)
        pairs = [(int(fps[i]), int(fps[j])) for x, y in simhash.close_pairs(tree, tree) for i, j in zip(x, y, strict=True)]
        assert connected(fps.tolist(), pairs) == plain_connected(fps.tolist())
        own, other = fps[: len(fps) // 3], fps[len(fps) // 3 :]
        across = {(int(own[i]), int(other[j])) for x, y in simhash.close_pairs(simhash.Tree(own), simhash.Tree(other)) for i, j in zip(x, y, strict=True)}
        for part in (own, other):
            t = simhash.Tree(part)
            across |= {(int(part[i]), int(part[j])) for x, y in simhash.close_pairs(t, t) for i, j in zip(x, y, strict=True)}
        assert connected(fps.tolist(), across) == plain_connected(fps.tolist())
    assert seen[0] > 1000 and seen[1] > 1000
    seen[:] = [0, 0]
    fps = in_gray_order(r.integers(0, 1 << 64, 20000, dtype=np.uint64))
    tree = simhash.Tree(fps)
    list(simhash.close_pairs(tree, tree))
    assert 0 < seen[0] < len(fps) ** 2 / 20


@pytest.mark.parametrize("range_size", [1 << 20, 40, 1])
def test_links_of_ranges_as_brute_force(spark, range_size):
    r = np.random.default_rng(19)
    fps = np.unique(np.concatenate([r.integers(0, 1 << free, n, dtype=np.uint64) << np.uint64(up) for (n, free), up in zip(CROWDS[1:], (54, 30, 0, 20, 24), strict=True)]))[::2 if range_size > 1 else 20]
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    pairs = [(x.a % (1 << 64), x.b % (1 << 64)) for x in simhash.links(df, range_size=range_size).collect()]
    assert len(pairs) < len(fps) * 4 and connected(fps.tolist(), pairs) == plain_connected(fps.tolist())
    assert simhash.links(df.where("fp is null")).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1001 + k) for k in range(300)]
    e = spark.createDataFrame([*chain, *star, (5, 5)], "a long, b long")
    got = {x.id: x.component for x in least_reachable(e).collect()}
    assert got == {**{k: 0 for k in range(1, 201)}, **{1001 + k: 1000 for k in range(300)}}
    assert least_reachable(e.where("a < 0")).count() == 0
