"""Verdicts on urls from pattern rules that are indexed by their rarest literal token.

A rule is a verdict and a pattern. ``host/path`` fits the host, all its subdomains and every path
that starts with the rule's path. A pattern with ``*`` is matched against ``//host/path?query#part``
as a whole, ``*`` standing for anything. Host rules come before patterns with ``*``; of several that
fit, the one with the most literal characters wins, then the smaller text.

Every rule is filed under one literal token: a run of [a-z0-9] that must stand in a fitting url as a
token of its own. Of a rule's tokens the one in the fewest urls is chosen, counted over all urls, so
that tokens like ``com`` fetch nothing. A url looks up its own tokens and only the rules found there
run their regular expression. A rule without such a token is tried on every url.

The index holds only the rules, and their size is checked before they are sent out.
Nulls: a null url, or one without ``://``, has an empty host and path and gets the default verdict.
Repeated rows are judged one by one. An empty table gives an empty result; columns other than the
two named are kept out. One job, for the counts, runs when called."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULE_BYTES = 64 << 20
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str

    @property
    def by_host(self) -> bool:
        return "*" not in self.pattern

    @property
    def rank(self) -> tuple[bool, int]:
        return self.by_host, len(self.pattern.replace("*", ""))

    @property
    def regex(self) -> str:
        if self.by_host:
            return r"\A//(?:[^/?#]*\.)?" + re.escape(self.pattern)
        return r"\A" + ".*".join(map(re.escape, self.pattern.split("*"))) + r"\Z"

    @property
    def tokens(self) -> list[str]:
        """Literals with a fixed character that is no part of a token, or the start, on both sides."""
        text = f".{self.pattern}*" if self.by_host else self.pattern
        return [m[0] for m in re.finditer(TOKEN, text.lower()) if "*" not in (text[m.start() - 1 : m.start()] or ".") and "*" not in (text[m.end() : m.end() + 1] or ".")]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def subject_of(url: Column) -> Column:
    """What patterns are matched against; empty without a host."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*(.*)\z", 1)
    return F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("://")), F.concat(F.lit("//"), host_of(url), rest)).otherwise("")


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Per row ``key``, host, path, rule and verdict, and the pattern that gave the verdict where
    it was one with ``*``."""
    if sum(len(r.pattern) for r in rules) > MOST_RULE_BYTES:
        raise ValueError("too many rules for an index that every task holds")
    subjects = pages.select(F.col(key).alias(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), subject_of(F.col(url)).alias("__subject"))
    literals = sorted({t for r in rules for t in r.tokens})
    found = F.array_intersect(F.regexp_extract_all(F.lower("__subject"), F.lit(f"({TOKEN})"), F.lit(0)), F.array(*map(F.lit, literals)).cast("array<string>"))
    counts = {r[0]: r[1] for r in subjects.select(F.explode(found).alias("token")).groupBy("token").count().collect()}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(rule)
    shared = pages.sparkSession.sparkContext.broadcast({t: [(r.rank, r.pattern, r.verdict, r.regex) for r in some] for t, some in index.items()})
    out = pa.schema([("rule", pa.string()), ("verdict", pa.string()), ("matched", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = {t: [(rank, p, v, re.compile(x, re.DOTALL)) for rank, p, v, x in some] for t, some in shared.value.items()}
        token = re.compile(TOKEN)
        for batch in batches:
            best = []
            for subject in batch.column("__subject").to_pylist():
                candidates = [r for t in {"", *token.findall(subject.lower())} & fetch.keys() for r in fetch[t]]
                fits = [r for r in candidates if r[3].match(subject)] if subject else []
                best.append(min(fits, key=lambda r: (not r[0][0], -r[0][1], r[1]), default=((False, 0), None, default, None)))
            columns = [[b[1] if b[0][0] else None for b in best], [b[2] for b in best], [None if b[0][0] else b[1] for b in best]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (key, "host", "path")), *(pa.array(c, f.type) for c, f in zip(columns, out, strict=True))], [key, "host", "path", *out.names])

    kind = subjects.schema[key].dataType.simpleString()
    return subjects.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string, matched string")
