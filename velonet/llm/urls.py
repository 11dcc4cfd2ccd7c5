"""URL filters: a trie over reversed host labels, then path segments; the longest matching rule decides.

The longest is the one with the most characters, host and path together; of two as long, the one with more of the host, and of
equal rules the last given. Rules go to the tasks as tries of about RULE_BYTES each, one a pass: each carries the best rule so far, and
its rows are written before the next, so any number of rules gives the same results, a worker holds one trie, and no row is shuffled.

Defined cases: a null url, or one without `://`, has an empty host and path and matches no rule; so does a url without a
path, as every rule's path begins with `/`. What no rule matches gets the default verdict. Repeated rows give a row each;
a very long url is split once, whole; other columns, whatever their names, aren't read; without rules everything gets the
default verdict; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.operators.scratch import discard, written

#: (verdict, host and path prefix)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Bytes of rules in a trie, which is about ten times as large in a worker.
RULE_BYTES = 8 << 20


class RuleTrie:
    """Nodes are dicts. Labels of the reversed host lead to nodes whose "/" child holds the path's segments.

    A rule's last path segment is a prefix of the url's (an empty one, after a closing slash, of any)."""

    def __init__(self, rules=RULES):
        self.root: dict = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})
            *whole, last = (slash + path).split("/")[1:] if slash else [""]
            for segment in whole:
                node = node.setdefault(("seg", segment), {})
            node.setdefault("ends", {})[last] = (verdict, rule)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule."""
        best, node = None, self.root
        if not path.startswith("/"):
            return None
        segments = path.split("/")[1:]
        for label in reversed(host.split(".")):
            node = node.get(label) if label != "/" else None
            if node is None:
                break
            best = longer(self._path(node.get("/"), segments), best)
        return best

    @staticmethod
    def _path(node: dict | None, segments: list[str]) -> tuple[str, str] | None:
        """The longest path among rules of one host."""
        best, k = None, 0
        while node is not None and k < len(segments):
            ends = node.get("ends")
            if ends:
                fits = [e for e in ends if segments[k].startswith(e)]
                best = ends[max(fits, key=len)] if fits else best
            node, k = node.get(("seg", segments[k])), k + 1
        return best


def longer(a: tuple[str, str] | None, b: tuple[str, str] | None) -> tuple[str, str] | None:
    """Of two fitting (verdict, rule) the one that decides; a, if they are the same rule."""
    if a is None or b is None:
        return a or b
    size = lambda r: (len(r[1]), len(r[1].partition("/")[0]))
    return a if size(a) >= size(b) else b


def tries(rules: Iterable[tuple[str, str]], rule_bytes: int = RULE_BYTES) -> Iterator[RuleTrie]:
    part, size = [], 0
    for verdict, rule in rules:
        part.append((verdict, rule))
        size += len(rule) + 64
        if size >= rule_bytes:
            yield RuleTrie(part)
            part, size = [], 0
    if part:
        yield RuleTrie(part)


_URL = re.compile(r"(?s)(?:(?!://).)*://([^/?#]*)([^?#]*)")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host after the first `://`, A-Z lower-cased; the path from there to `?` or `#`."""
    m = _URL.match(url or "")
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url", rule_bytes: int = RULE_BYTES) -> DataFrame:
    """Per row: page_id, host, path, rule (or null), verdict. Only id and url are read; nothing is shuffled. The default rules, and any
    others that fit one trie, are a single pass without writing."""
    names = ["page_id", "host", "path", "rule", "verdict"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [split_url(u) for u in b["url"].to_pylist()]
            none = pa.nulls(len(parts), pa.string())
            yield pa.RecordBatch.from_arrays([b["page_id"], pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), none, none], names=names)

    def match(trie):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = []
                for host, path, rule, verdict in zip(*(b[c].to_pylist() for c in names[1:]), strict=True):
                    found.append(longer(trie.value.find(host, path), None if rule is None else (verdict, rule)) or (None, None))
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([r for _, r in found], pa.string()), pa.array([v for v, _ in found], pa.string())], names=names)

        return run

    schema = "page_id long, host string, path string, rule string, verdict string"
    out = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).mapInArrow(split, schema)
    for k, trie in enumerate(tries(rules, rule_bytes)):
        # a stage holds the tries of all its passes at once
        out, before = written(out, "urls") if k else out, out
        discard(before)
        out = out.mapInArrow(match(pages.sparkSession.sparkContext.broadcast(trie)), schema)
    return out.fillna(default, ["verdict"])
