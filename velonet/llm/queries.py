"""The operators as queries over the bundled tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velonet.llm import decontam, divergence, fingerprints, lloyd, lm_score, packing, quality, secret_scan, simhash, substring_dedup, toxicity, urls, vector_graph
from velonet.llm.common import read


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_with_ledger(read(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [r.kind for r in secret_scan.BASE]
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    n = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *n, F.sha2(line(of(base)), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edited(read(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.cross_entropy_difference(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.kept_digest(substring_dedup.remove_repeats(read(spark, sf_dir, "documents")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    graded = quality.grade_documents(docs, quality.train(docs, read(spark, sf_dir, "labels")))
    return graded.select("doc_id", "expected_grade", F.col("tail")[0].alias("p_grade_1"), F.col("tail")[1].alias("p_grade_2"), "keep")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(read(spark, sf_dir, "embeddings"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(read(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


_OPERATORS = (op1_secret_scan, op2_best_fit_packing, op3_document_fingerprints, op4_lm_scoring, op5_decontamination, op6_substring_dedup, op7_simhash, op8_quality, op9_url_filters, op10_toxicity, op11_centroid_clustering, op12_embedding_near_dedup, op13_source_divergence)
QUERIES = {f.__name__: f for f in _OPERATORS}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"



def _lloyd_sql(rounds: int = 3) -> str:
    d = lambda c: f"list_sum(list_transform(list_zip(x.q, {c}.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    out = """
with e as (select vec_id, embedding v from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda z: z is not null and isfinite(z))) = 64),
x as materialized (select row_number() over () r, vec_id, list_transform(v, lambda z: cast(floor(64 * cast(z as double)) as bigint)) q from e),
c0 as materialized (select row_number() over (order by sha256('1:' || vec_id), q) - 1 cluster, q from x order by sha256('1:' || vec_id), q limit 16)"""
    for n in range(rounds + 1):
        out += f""",
a{n} as materialized (select r, min(row(d, cluster)) b from (select r, c.cluster, {d("c")} d from x, c{n} c) group by r)"""
        if n < rounds:
            out += f""",
m{n} as (select cluster, i, sum(z) s, count(*) n from (select a.b[2] cluster, unnest(x.q) z, unnest(range(1, 65)) i from a{n} a join x using (r)) group by all),
c{n + 1} as materialized (select c.cluster, coalesce(m.q, c.q) q from c{n} c left join (select cluster, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) q from m{n} group by cluster) m using (cluster))"""
    return out + f""",
f as (select x.vec_id, cast(b[2] as integer) cluster, cast(b[1] as bigint) distance from a{rounds} join x using (r))
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) cluster_inertia, cast(sum(distance) over () as bigint) inertia, sha256(array_to_string(c.q, ',')) centroid_sha256 from f join c{rounds} c using (cluster)"""


SQL = {
    "op11_centroid_clustering": _lloyd_sql(),
    "op5_decontamination": rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
b2 as (select item_id, w, least(10, len(w)) m from b where len(w) > 0),
bw as (select item_id, m, array_to_string(w[p:p + m - 1], ' ') g from (select item_id, w, m, unnest(range(1, len(w) - m + 2)) p from b2)),
sizes as (select distinct m from bw),
dw as (select doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') g from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) p from d, sizes where len(w) >= m)),
hits as (select doc_id, p, dw.m, item_id from dw join bw on dw.m = bw.m and dw.g = bw.g),
n as (select doc_id, count(distinct i) n_hit from (select doc_id, unnest(range(p, p + m)) i from hits) group by doc_id),
it as (select doc_id, count(distinct item_id) n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) ids from hits group by doc_id)
select d.doc_id, len(d.w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join n using (doc_id) left join it using (doc_id)""",
    "op6_substring_dedup": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
g as (select doc_id, p, array_to_string(w[p:p + 12], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 11)) p from d where len(w) >= 13)),
m as (select g, min(doc_id) least_id from g group by g),
gone as (select distinct doc_id, unnest(range(p, p + 13)) i from g join m using (g) where least_id < doc_id),
kept as (select x.doc_id, string_agg(x.word, ' ' order by x.i) t, count(*) n from (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) i from d) x anti join gone on x.doc_id = gone.doc_id and x.i = gone.i group by x.doc_id)
select d.doc_id, len(d.w) n_words, len(d.w) - coalesce(n, 0) n_removed, sha256(coalesce(t, '')) kept_sha256 from d left join kept using (doc_id)""",
    "op9_url_filters": rf"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end r from pages),
h as (select page_id, translate(regexp_extract(r, '^[^/?#]*'), {_AZ}) host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) path from u),
rules(verdict, host, path, rule) as (values ('allow', 'com', '/', 'com/'), ('block', 'example.com', '/en/', 'example.com/en/'), ('allow', 'www.example.com', '/en/', 'www.example.com/en/'), ('block', 'net', '/es/', 'net/es/'), ('block', 'net', '/fr/', 'net/fr/')),
best as (select page_id, arg_max(struct_pack(rule := x.rule, verdict := x.verdict), length(x.rule)) b from h join rules x on (h.host = x.host or ends_with(h.host, '.' || x.host)) and starts_with(h.path, x.path) group by page_id)
select page_id, host, path, b.rule as rule, coalesce(b.verdict, 'allow') verdict from h left join best using (page_id)""",
    "op13_source_divergence": rf"""
with d as (select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') w from documents),
w as (select r, lang, source, unnest(w) term from d),
c as (select lang, source, term, count(*) n from w group by all),
kept as (select lang, term, count(distinct r) docs, count(*) total from w group by all having docs >= 10),
langs as (select lang, count(*) v, sum(total) n from kept group by 1),
groups as (select distinct lang, source from d),
full_ as (select g.lang, g.source, k.term, k.total, coalesce(c.n, 0) n from groups g join kept k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sums as (select lang, source, sum(n) n from full_ group by all),
pq as (select f.lang, f.source, f.term, f.n, 1 + (1000000000::hugeint * (f.n + 2)) // (s.n + 2 * l.v) p, 1 + (1000000000::hugeint * (f.total + 2)) // (l.n + 2 * l.v) q from full_ f join sums s on f.lang = s.lang and f.source = s.source join langs l on l.lang = f.lang),
pairs as (select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) x from pq a join pq b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, 'pair' part, b.source item, coalesce(x, 0) x from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source),
term as (select lang, source, 'term' part, term item, ((p - q) * (p - q)) // (p + q) x from pq where n > 0 and p > q)
select lang, source, part, item, cast(x as bigint) as value, cast(row_number() over (partition by lang, source, part order by x desc, item) as integer) rank from (from pair union all from term) qualify part = 'pair' or rank <= 10""",
}
