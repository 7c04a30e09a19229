"""URL filter: a trie over reversed host labels and path segments, with longest-match precedence.

Rules name a host and a path, ``example.net/en/``. A rule fits its host and all its subdomains if the
path of the address starts with the rule's path. Of the fitting rules the longest wins: more host labels
first, then the longer path; of an allow and a block rule for the same host and path, block wins.

Rules are kept in a trie whose first levels are the labels of the host from the last one on, and whose
further levels are whole path segments. What follows the last slash of a rule's path may end inside a
segment, so it is kept at its node as a prefix. The trie is broadcast; at most ``max_rules`` rules go into one, and
longer lists are cut into several tries that are applied one after the other, so any number of rules works.

Defined results: a null address, or one without ``://``, has an empty host and path and gets the default verdict;
so does an address that no rule fits. An empty path does not start with ``/``, so a rule with a path does not fit it.
Repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package

ALLOW, BLOCK = "allow", "block"


@dataclass
class Node:
    """``below``: next host labels or path segments. ``path``: where the path of rules for this host begins.
    ``ends``: (unfinished segment, verdict, rule) of the rules that end here."""

    below: dict[str, Node] = field(default_factory=dict)
    path: Node | None = None
    ends: list[tuple[str, str, str]] = field(default_factory=list)


def split_rule(rule: str) -> tuple[list[str], list[str]]:
    """Host labels from the last one on, and path segments; a path without a slash has none."""
    host, slash, path = rule.partition("/")
    return host.lower().split(".")[::-1] if host else [], (path.split("/") if slash else [])


def build_trie(rules: Iterable[tuple[str, str]]) -> Node:
    root = Node()
    for verdict, rule in rules:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"unknown verdict {verdict!r}")
        labels, segments = split_rule(rule)
        node = root
        for label in labels:
            node = node.below.setdefault(label, Node())
        if segments:
            node.path = node.path or Node()
            node = node.path
            for segment in segments[:-1]:
                node = node.below.setdefault(segment, Node())
            node.ends.append((segments[-1], verdict, rule))
        else:
            node.ends.append(("", verdict, rule))
    return root


def longest(root: Node, host: str, path: str) -> tuple[tuple[int, int, int], str, str] | None:
    """(length, verdict, rule) of the longest fitting rule; the length orders rules of different tries too."""
    best = None

    def offer(depth: int, length: int, verdict: str, rule: str) -> None:
        nonlocal best
        found = ((depth, length, verdict == BLOCK), verdict, rule)
        if best is None or found[0] > best[0]:
            best = found

    segments = path.split("/")[1:] if path.startswith("/") else None
    node, depth = root, 0
    labels = host.split(".")[::-1] if host else []
    while True:
        for _, verdict, rule in node.ends:
            offer(depth, -1, verdict, rule)
        if node.path is not None and segments is not None:
            inner, used = node.path, 0
            for i, segment in enumerate(segments):
                for rest, verdict, rule in inner.ends:
                    if segment.startswith(rest):
                        offer(depth, used + len(rest), verdict, rule)
                used += len(segment) + 1
                if i + 1 == len(segments) or (inner := inner.below.get(segment)) is None:
                    break
        if depth == len(labels) or (node := node.below.get(labels[depth])) is None:
            return best
        depth += 1


def host_of(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_filter(urls: DataFrame, rules: Iterable[tuple[str, str]], url_column: str = "url", default: str = ALLOW,
               max_rules: int = 200_000) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced."""
    rules = list(rules)
    context = urls.sparkSession.sparkContext
    tries = [context.broadcast(build_trie(rules[i:i + max_rules])) for i in range(0, len(rules), max_rules)]

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        roots = [trie.value for trie in tries]
        for hosts, paths in batches:
            found = [max(filter(None, (longest(root, host, path) for root in roots)), default=None)
                     for host, path in zip(hosts, paths, strict=True)]
            yield pd.DataFrame({"rule": [x and x[2] for x in found], "verdict": [x[1] if x else default for x in found]})

    ship_package(urls.sparkSession)
    parted = urls.withColumns({"host": host_of(url_column), "path": path_of(url_column)})
    # A user-defined function on columns of its own projection: the patterns are evaluated once.
    judged = parted.withColumn("_judged", judge("host", "path"))
    return judged.withColumns({"rule": F.col("_judged.rule"), "verdict": F.col("_judged.verdict")}).drop("_judged")
