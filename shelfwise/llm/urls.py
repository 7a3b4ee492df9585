"""URL filter: a trie over reversed host labels, and below each host over path segments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh
from shelfwise.session import materialize

#: Characters of rules in one broadcast trie; more rules make several tries, used one after another.
TRIE_CHARS = 32_000_000
ALLOW, BLOCK = "allow", "block"
CAPITALS, SMALLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def rank(self) -> tuple[int, int, bool]:
        """Longest text first, then longest host; of two equal rules the blocking one."""
        return len(self.text), len(self.host), self.verdict == BLOCK


@dataclass
class PathNode:
    below: dict[str, PathNode] = field(default_factory=dict)
    #: Rules that end inside this segment: by the part of it that they name.
    ends: dict[str, Rule] = field(default_factory=dict)


@dataclass
class HostNode:
    below: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


class UrlTrie:
    def __init__(self, rules: list[Rule]):
        self.root = HostNode()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.below.setdefault(label, HostNode())
            node.paths = at = node.paths or PathNode()
            *whole, last = rule.path.split("/")
            for segment in whole:
                at = at.below.setdefault(segment, PathNode())
            if last not in at.ends or rule.rank > at.ends[last].rank:
                at.ends[last] = rule

    def _fits(self, host: str, path: str) -> Iterator[Rule]:
        segments = path.split("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                return
            at = node.paths
            for depth, segment in enumerate(segments):
                if at is None:
                    break
                for length in {len(e) for e in at.ends}:
                    if segment[:length] in at.ends and length <= len(segment):
                        yield at.ends[segment[:length]]
                at = at.below.get(segment) if depth + 1 < len(segments) else None

    def best(self, host: str | None, path: str | None) -> Rule | None:
        """The longest rule that fits."""
        return max(self._fits(host, path or ""), key=lambda r: r.rank, default=None) if host else None


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (capital A-Z made small) and path; both empty where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, CAPITALS, SMALLS), path


def _tries(rules: list[Rule], most: int) -> Iterator[UrlTrie]:
    own, size = [], 0
    for rule in sorted(set(rules)):
        if own and size + len(rule.text) > most:
            yield UrlTrie(own)
            own, size = [], 0
        own.append(rule)
        size += len(rule.text)
    yield UrlTrie(own)


def _looker(shared: Broadcast[UrlTrie]):
    @F.pandas_udf("verdict string, host string, path string")
    def look(hosts: pd.Series, paths: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for h, p, *old in zip(hosts, paths, before["verdict"], before["host"], before["path"], strict=True):
            found = [r for r in (shared.value.best(h, p), Rule(*old) if isinstance(old[0], str) else None) if r]
            rows.append(max(found, key=lambda r: r.rank, default=(None, None, None)))
        return pd.DataFrame(rows, columns=["verdict", "host", "path"])

    return look


def judge_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", default: str = ALLOW, trie_chars: int = TRIE_CHARS
) -> DataFrame:
    """``pages`` with host, path, rule (text of the longest rule that fits, or null) and verdict (its, or ``default``).

    Columns of these names in ``pages`` are replaced; all others are kept, nulls and repeated rows included. A null URL
    or one without ``://`` has empty host and path and fits no rule. Rules of equal length: the longer host wins, then
    the blocking one. Rules are broadcast as a trie of at most ``trie_chars`` characters; more of them are dealt to
    several tries, and the rows pass them one after another with the best match so far.
    """
    host, path = url_parts(F.col(f"`{url}`"))
    own, matched = ("host", "path", "rule", "verdict"), "matched"
    out = pages.withColumns({(h := fresh(pages, "url_host")): host, (p := fresh(pages, "url_path")): path})
    out = out.drop(*(c for c in out.columns if c.lower() in own and c != url))
    matched = fresh(out, matched)
    out = out.withColumn(matched, F.lit(None).cast("struct<verdict: string, host: string, path: string>"))
    tries = list(_tries(rules, trie_chars))
    for number, trie in enumerate(tries):
        shared = pages.sparkSession.sparkContext.broadcast(trie)

        out = out.withColumn(matched, _looker(shared)(h, p, matched))
        if number + 1 < len(tries):
            out = materialize(out)
            shared.unpersist()
    rule = F.when(F.col(matched)["verdict"].isNotNull(), F.concat(F.col(matched)["host"], F.col(matched)["path"]))
    verdict = F.coalesce(F.col(matched)["verdict"], F.lit(default))
    kept = [F.col(f"`{c}`") for c in out.columns if c not in (h, p, matched)]
    return out.select(*kept, F.col(h).alias("host"), F.col(p).alias("path"), rule.alias("rule"), verdict.alias("verdict"))
