"""URL filter: a trie over reversed host labels and path segments decides between allow and block entries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES_PER_TRIE = 200_000


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, restricted to paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


class _PathNode:
    __slots__ = ("children", "endings", "lengths")

    def __init__(self) -> None:
        self.children: dict[str, _PathNode] = {}
        self.endings: dict[str, Rule] = {}  # start of the next segment -> rule
        self.lengths: set[int] = set()


class _HostNode:
    __slots__ = ("children", "paths")

    def __init__(self) -> None:
        self.children: dict[str, _HostNode] = {}
        self.paths: _PathNode | None = None


class UrlTrie:
    """Host labels from the top-level domain down, then complete path segments, then the start of the next segment.

    A lookup walks at most as many labels and segments as the longest rule has, so long urls cost no more than short ones.
    Of two rules for the same place, block wins.
    """

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.root = _HostNode()
        self.labels = self.segments = 0
        for rule in rules:
            labels = rule.host.translate(str.maketrans(UPPER, LOWER)).split(".")[::-1]
            *complete, ending = rule.path.split("/")
            self.labels, self.segments = max(self.labels, len(labels)), max(self.segments, len(complete))
            host = self.root
            for label in labels:
                host = host.children.setdefault(label, _HostNode())
            host.paths = node = host.paths or _PathNode()
            for segment in complete:
                node = node.children.setdefault(segment, _PathNode())
            node.lengths.add(len(ending))
            if ending not in node.endings or rule.verdict == "block":
                node.endings[ending] = rule

    @staticmethod
    def _longest_path(node: _PathNode, segments: list[str]) -> Rule | None:
        best = None
        for i, segment in enumerate(segments):
            fitting = [r for n in node.lengths if (r := node.endings.get(segment[:n])) and len(segment) >= n]
            best = max([best, *fitting] if best else fitting, key=lambda r: len(r.path), default=None)
            if i == len(segments) - 1 or segment not in node.children:
                return best
            node = node.children[segment]
        return best

    def longest(self, host: str, path: str) -> Rule | None:
        """The fitting rule with the longest host plus path; of equally long ones that with the longer host."""
        segments = path.split("/", self.segments + 1)
        best, node = None, self.root
        for label in host.rsplit(".", self.labels)[::-1][: self.labels]:
            if (node := node.children.get(label)) is None:
                break
            if node.paths and (rule := self._longest_path(node.paths, segments)):
                if best is None or len(rule.text) >= len(best.text):
                    best = rule
        return best


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _judge_with(shared: Broadcast):
    @F.pandas_udf("struct<size int, host_size int, blocks boolean, rule string, verdict string>")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for hosts, paths in parts:
            best = [trie.longest(h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(
                [(len(r.text), len(r.host), r.verdict == "block", r.text, r.verdict) if r else (-1, -1, False, None, None) for r in best],
                columns=["size", "host_size", "blocks", "rule", "verdict"],
            )

    return judge


def filter_urls(
    df: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_rules: int = MAX_RULES_PER_TRIE,
) -> DataFrame:
    """One row per row of ``df``: id, host, path, the longest fitting rule (or null) and the verdict.

    Rules are broadcast in tries of at most ``max_rules`` entries; a longer list takes several tries one after the other, and the
    longest answer of all of them counts, so the result does not depend on the limit.  A null url or one without ``://``
    has an empty host and path; it, and any url that no rule fits, gets ``default``.  Repeated rows and null ids are judged
    like any other, an empty table gives an empty result, and columns other than the two named ones are ignored.
    """
    spark = df.sparkSession
    pages = pick(df, id=id_col, url=url_col).select(
        F.col("id").alias(id_col), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    ordered = sorted(set(rules), key=lambda r: (r.text, r.host, r.verdict))
    found = []
    for start in range(0, len(ordered), max_rules):
        shared = spark.sparkContext.broadcast(UrlTrie(ordered[start : start + max_rules]))
        found.append(_judge_with(shared)("host", "path"))
    if not found:
        return pages.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    best = found[0] if len(found) == 1 else F.greatest(*found)
    judged = pages.withColumn("_best", best)
    return judged.select(
        id_col, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )
