"""Secret scans through an incremental blob ledger.

Every version of every file is named by the SHA-256 of its content (a blob). A ledger table holds which
(blob, rule version) pairs were scanned and what was found. A scan reads only blobs that have unseen pairs, each
distinct blob once however many paths and versions share it, and joins the findings back to all paths. The op1 query and
redact() begin a ledger of their own where they are given none; a caller that keeps one has only what is new scanned.

Defined cases: a null or empty text is the empty blob, without findings; repeated rows give a row each; a null id stays
null; an empty table gives an empty result; extra columns, whatever their names, aren't read, and pass redact() as they are.
Texts are scanned whole, very long ones too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import by_size, scratch_path, texts
from velonet.operators.scratch import discard, written


@dataclass(frozen=True)
class Rule:
    """A match counts if `group` of it has at least `least` characters. hints: a text without any of them can't match."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds come first, in the order that breaks ties of start.
BASE = (
    Rule("assign", 1, r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, ("private key-----",)),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, ("eyj",)),
    Rule("forge", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(text: str, rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then by the order of the rules."""
    lower, found = text.lower(), []
    for rank, rule in enumerate(rules):
        if rule.hints and not any(h in lower for h in rule.hints):
            continue
        for m in re.finditer(rule.pattern, text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), rank, m.end()))
    return [(rules[rank].kind, start, end) for start, rank, end in sorted(found)]


def blobs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, text): one row per path or version."""
    d = texts(docs, id_col, text_col)
    return d.select("doc_id", F.sha2(F.col("text"), 256).alias("blob"), "text")


def scan_unseen(blobs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rules, spans): each distinct blob with unseen rule versions, and what those rules found.

    ledger: earlier rows of the same form, or None. Distinct blobs are combined before the shuffle, so that a content
    which a third of all paths share crosses it once per task."""
    keys = [r.key for r in rules]
    distinct = blobs.select("blob", "text").dropDuplicates(["blob"])
    if ledger is None:
        todo = distinct.withColumn("rules", F.array(*map(F.lit, keys)))
    else:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = distinct.join(seen, "blob", "left").withColumn("rules", F.array_except(F.array(*map(F.lit, keys)), F.coalesce("seen", F.array().cast("array<string>"))))
        todo = todo.where(F.size("rules") > 0)
    by_key = {r.key: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t, tuple(by_key[x] for x in own))] for t, own in zip(b["text"].to_pylist(), b["rules"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["blob"], b["rules"], pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))], names=["blob", "rules", "spans"])

    return todo.select("blob", "rules", "text").mapInArrow(scan, f"blob string, rules array<string>, spans {SPANS}")


def findings_by_path(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every path: the ledger's findings under the present rule versions, joined on the content.

    Blobs without findings never cross the join; a content with very many paths is a skewed key of a left join, which
    adaptive execution splits."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    now = F.array(*[F.lit(r.key) for r in rules])
    found = (
        ledger.where((F.size("spans") > 0) & F.arrays_overlap("rules", now))
        .select("blob", F.explode("spans").alias("s"), "rules")
        .where(F.exists("rules", lambda k: F.substring_index(k, "@", 1).eqNullSafe(F.col("s.kind")) & F.array_contains(now, k)))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct(F.col("s.start").alias("start"), F.try_element_at(order, F.col("s.kind")).alias("rank"), F.col("s.end").alias("end"), F.col("s.kind").alias("kind")))).alias("x"))
        .select("blob", F.transform("x", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    )
    return blobs.select("doc_id", "blob").join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings per path, new ledger rows). The caller appends the second to its ledger; see scan_with_ledger()."""
    blobs = blobs_of(docs, id_col, text_col)
    new = scan_unseen(blobs, ledger, rules)
    return findings_by_path(blobs, new if ledger is None else ledger.select("blob", "rules", "spans").unionByName(new), rules), new


def scan_with_ledger(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scans against the ledger stored at ledger_path (Parquet; made if absent; None: one of its own), appends what is new, returns
    findings per path."""
    spark = docs.sparkSession
    ledger_path = ledger_path or scratch_path(spark, "ledger")
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    there = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
    blobs = blobs_of(docs, id_col, text_col)
    if there:  # first elsewhere: the ledger is read while this is made
        fresh = written(scan_unseen(blobs, spark.read.parquet(ledger_path), rules), "fresh")
        fresh.write.mode("append").parquet(ledger_path)
        discard(fresh)
    else:
        scan_unseen(blobs, None, rules).write.parquet(ledger_path)
    return findings_by_path(blobs, spark.read.parquet(ledger_path), rules)


def redact(docs: DataFrame, mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES, ledger_path: str | None = None) -> DataFrame:
    """docs with every found span of `text` replaced by the mask and n_chars brought up to date; nothing else changes.

    The spans are scan_with_ledger()'s, each distinct content scanned once; only findings that aren't empty are joined to docs,
    on the content's hash. mask must not match a rule. Of other columns' names, only __blob and __spans are this operator's own."""
    found = scan_with_ledger(docs, ledger_path, rules)
    spans = written(found.where(F.size("spans") > 0).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")).dropDuplicates(["__blob"]), "findings")
    joined = docs.withColumn("__blob", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).join(spans, "__blob", "left").select(*docs.columns, "__spans")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            out = []
            for t, own in zip(b["text"].to_pylist(), b["__spans"].to_pylist(), strict=True):
                done, at = [], 0
                for s, e in ((x["start"], x["end"]) for x in own or []):
                    if e > at:
                        done += [t[at:s], mask] if s >= at else []
                        at = e
                out.append("".join(done) + t[at:] if done else t)
            b = b.drop_columns(["__spans"])
            yield b.set_column(b.schema.get_field_index("text"), b.schema.field("text"), pa.array(out, b.schema.field("text").type))

    out = joined.mapInArrow(clean, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out
