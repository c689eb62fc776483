"""URL rules, and their spread over redirects and canonical links.

A rule names a host with its subdomains and a path prefix. URLs that no rule
fits take the decision of their aliases: all URLs that redirects and canonical
links connect, found as connected components. An allowed alias outweighs any
number of blocked ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources import stages
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(text: str, verdict: str) -> Rule:
    """``example.net/en/`` as a rule for that host, its subdomains and that path prefix."""
    host, slash, path = text.partition("/")
    if not host or verdict not in ("allow", "block"):
        raise ValueError(f"no rule: {text!r}, {verdict!r}")
    return Rule(host.translate(str.maketrans(_UPPER, _LOWER)), slash + path, verdict)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z in lower case; NULL or no ``://`` gives ''."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def node(url: Column) -> Column:
    """The URL as a node of the alias graph: no scheme, no fragment; NULL where there is no host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)
    name = F.concat(host(url), F.when(path(url) == "", "/").otherwise(path(url)), query)
    return F.when(host(url) != "", name)


def deciding_rule(host_of: Column, path_of: Column, rules: Sequence[Rule]) -> Column:
    """struct of the longest rule that fits, allow before block among equals; NULL if none does."""
    listed = F.array(*[
        F.struct(
            F.lit(len(r.name)).alias("length"), F.lit(r.verdict == "allow").alias("allowed"),
            F.lit(r.name).alias("rule"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path"),
            F.lit(r.verdict).alias("verdict"),
        )
        for r in rules
    ])
    fitting = F.filter(listed, lambda r: (
        ((host_of == r["host"]) | F.endswith(host_of, F.concat(F.lit("."), r["host"])))
        & F.startswith(path_of, r["path"])
    ))
    return F.array_max(fitting)


_TAG = re.compile(r"<(link|meta)\b([^>]*)>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_REFRESH = re.compile(r"^\s*[\d.]*\s*[;,]?\s*url\s*=\s*['\"]?([^'\"\s]+)", re.IGNORECASE)


def link_targets(html: str) -> list[str]:
    """Targets of the canonical links and immediate refreshes of a page, as written."""
    found = []
    for kind, rest in _TAG.findall(html):
        values = {n.lower(): unescape(a or b or c).strip() for n, a, b, c in _ATTRIBUTE.findall(rest)}
        if kind.lower() == "link" and "canonical" in values.get("rel", "").lower().split():
            found.append(values.get("href", ""))
        elif kind.lower() == "meta" and values.get("http-equiv", "").lower() == "refresh":
            target = _REFRESH.search(values.get("content", ""))
            found.append(target[1] if target else "")
    return [t for t in found if t]


def _resolved(url: str, target: str) -> str | None:
    """A link target as a full URL: absolute, ``//host``, ``/path`` or relative to the page's folder."""
    if "://" in target:
        return target
    if target.startswith("//"):
        return "x:" + target
    base = re.match(r"(?s)(.*?://[^/?#]*)([^?#]*)", url)
    if not base:
        return None
    folder = base[2][:base[2].rfind("/") + 1] or "/"
    return base[1] + (target if target.startswith("/") else folder + target)


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): nodes that a page's canonical links and immediate refreshes tie to its own URL.

    Every such tag of the whole page counts. A page without URL or html has
    none. Only pages that hold one of the two words leave the JVM.
    """
    chosen = pages.select(F.col(url).alias("u"), F.col(html).alias("h")).where(
        F.col("u").isNotNull() & F.rlike(F.col("h"), F.lit(r"(?i)canonical|http-equiv"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (u, full) for u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for t in link_targets(h) if (full := _resolved(u, t))
            ]
            columns = list(zip(*pairs)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["u", "t"])

    found = chosen.mapInArrow(run, "u string, t string")
    return found.select(node(F.col("u")).alias("a"), node(F.col("t")).alias("b")).where(
        "a IS NOT NULL AND b IS NOT NULL AND a <> b"
    )


def alias_verdicts(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(node, alias_verdict) of every node in a component that holds a node with a rule.

    The rules are applied to all nodes of the edges, whether or not a page has
    that URL. Components are only aggregated, so their size does not matter.
    """
    nodes = connected_components(edges)
    full = F.concat(F.lit("x://"), F.col("node"))
    decided = nodes.withColumn("_v", deciding_rule(host(full), path(full), rules)["verdict"])
    whole = decided.groupBy("component").agg(
        F.max(F.when(F.col("_v") == "allow", 2).when(F.col("_v") == "block", 1)).alias("_best")
    ).where("_best IS NOT NULL")
    return nodes.join(whole, "component").select(
        "node", F.when(F.col("_best") == 2, "allow").otherwise("block").alias("alias_verdict")
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule], edges: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``.

    A fitting rule decides; without one the aliases do (allow before block);
    without those, ``default``. NULL URLs and texts without ``://`` have an
    empty host and path, fit no rule, have no aliases and get ``default``.
    Repeated URLs get equal verdicts; columns of the added names are replaced.

    ``edges`` (a, b) holds nodes as ``node`` names them: redirects from a crawl
    log as well as ``alias_edges``. The verdicts of aliases are written first:
    the planner broadcasts them only while they are small.
    """
    aliases = stages.stage(alias_verdicts(edges, rules), "aliases")
    column = F.col(url)
    decided = (
        pages.drop("host", "path", "rule", "verdict")
        .withColumns({"_node": node(column), "host": host(column), "path": path(column)})
        .withColumn("_rule", deciding_rule(F.col("host"), F.col("path"), rules))
    )
    return (
        decided.join(aliases.withColumnRenamed("node", "_node"), "_node", "left")
        .withColumn("rule", F.col("_rule")["rule"])
        .withColumn("verdict", F.coalesce(F.col("_rule")["verdict"], F.col("alias_verdict"), F.lit(default)))
        .drop("_node", "_rule", "alias_verdict")
    )
