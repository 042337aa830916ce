"""URL filters: rules for hosts and paths, then trust and distrust spread over the graph of host links.

DataFrame functions only.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)

#: An absolute link: its host in group 1. Links without a host stay on theirs and make no edge.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")


def host_and_path(rows: DataFrame, url_col: str = "url") -> DataFrame:
    """rows with columns host (A-Z lower-cased) and path; a null url, or one without ://, has both empty."""
    rest = rows.withColumn("_url", F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    rest = rest.withColumn("_rest", _after_scheme(F.col("_url")))
    host = F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return rest.withColumn("host", host).withColumn("path", path).drop("_url", "_rest")


def matched_rule(rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits columns host and path, or null.

    A rule fits its host and all subdomains of it, where the path starts with the rule's. rules is a short list
    of the job's, not a table.
    """
    out = F.lit(None)
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        name = host + path
        found = F.struct(F.lit(name).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(own & F.col("path").startswith(path), found).otherwise(out)
    return out.cast("struct<rule: string, verdict: string>")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b, n): n links from pages of host a to another host b."""
    links = host_and_path(pages.select(url_col, html_col), url_col)
    links = links.select(F.col("host").alias("a"), F.explode(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(1))).alias("b"))
    links = links.withColumn("b", F.translate("b", UPPER, LOWER)).filter("a <> '' and b <> '' and a <> b")
    return links.groupBy("a", "b").agg(F.count("*").alias("n"))


def propagate(
    edges: DataFrame, seeds: DataFrame, *, damping: float = 0.85, tolerance: float = 1e-6, write_every: int = 5, most_small: int = 200_000,
) -> DataFrame:
    """(kind, host, score) by personalised PageRank.

    edges: (kind, a, b, share): host b gets share of a's score times damping. seeds: (kind, host, score): what a host has of
    its own in every round. Rounds end when no score changed by over tolerance times (1 - damping), which leaves each within
    tolerance of the limit, and at the latest when damping has faded below that. Every few rounds the scores are written to
    the shared folder, which bounds the plan; tables of most_small rows and fewer are broadcast.
    """
    edges, restart = common.small(edges, most_small), common.small(common.written(seeds, "host-seeds"), most_small)
    scores, before = restart, restart
    most = max(1, ceil(log(tolerance * (1 - damping)) / log(damping))) if 0 < damping < 1 else 1
    for k in range(1, most + 1):
        flow = scores.withColumnRenamed("host", "a").join(edges, ["kind", "a"])
        flow = flow.groupBy("kind", F.col("b").alias("host")).agg(F.sum(F.col("score") * F.col("share") * damping).alias("score"))
        before, scores = scores, flow.unionByName(restart).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % write_every == 0 or k == most:
            scores = common.written(scores, "host-scores")
            both = scores.join(before.withColumnRenamed("score", "old"), ["kind", "host"], "left")
            change = both.agg(F.max(F.col("score") - F.coalesce("old", F.lit(0.0)))).first()[0]
            if (change or 0.0) <= tolerance * (1 - damping):
                break
    return scores


def judge(
    pages: DataFrame, rules=RULES, *, threshold: float = 0.25, damping: float = 0.85, tolerance: float = 1e-6,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most_small: int = 200_000,
) -> DataFrame:
    """A row for each page: page_id, host, path, rule (or null), verdict, trust, distrust.

    The longest rule that fits decides. Pages without one are judged by host. A host's seed is the share of its pages that
    rules allow (for trust) or block (for distrust). Trust is personalised PageRank along links: a host passes it on to
    the hosts it links to, by numbers of links; a host whose pages are all allowed has 1 of its own. Distrust is the same against links: a host takes over, of each host it links
    to, that host's distrust by the share of its own links that lead there, so distrust says how much of what a reader
    finds from a host on is blocked, however many other hosts link there too. It is 0 to 1: the chance that a walk from the
    host, which stops with 1 - damping at each page and where no link leads on, stops at a blocked page.

    A host whose distrust exceeds both threshold and its trust is blocked, all others are allowed; at equality too.

    Edges are counted by pair of hosts before they are used, so a page or host with many links is some rows only. Links
    without a host stay on theirs and make no edge: where pages have no others, the seeds alone decide. Null urls have an
    empty host, which is no seed and is allowed; null html has no links. Very long urls and pages are read whole. Repeated
    rows each give a row and count as pages. An empty table gives no rows. Columns other than the three are not read.
    """
    own = host_and_path(pages.select(F.col(id_col).alias("page_id"), url_col), url_col).withColumn("_rule", matched_rule(rules))
    share = lambda verdict: F.avg(F.coalesce((F.col("_rule.verdict") == verdict).cast("int"), F.lit(0)))
    hosts = own.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    links = common.written(host_edges(pages, url_col, html_col), "host-links")
    out = common.written(links.groupBy("a").agg(F.sum("n").alias("total")), "host-totals")
    shares = links.join(common.small(out, most_small), "a").select("a", "b", (F.col("n") / F.col("total")).alias("share"))
    against = shares.select(F.lit("distrust").alias("kind"), F.col("b").alias("a"), F.col("a").alias("b"), "share")
    edges = common.written(shares.select(F.lit("trust").alias("kind"), "a", "b", "share").unionByName(against), "host-edges")
    seeds = hosts.unpivot(["host"], ["trust", "distrust"], "kind", "seed").filter("seed > 0")
    seeds = seeds.join(out.select(F.col("a").alias("host"), "total"), "host", "left")
    ends = (F.col("kind") == "trust") | F.col("total").isNull()  # a walk that no link leads on from stops; trust is not a chance
    seeds = seeds.select("kind", "host", (F.col("seed") * F.when(ends, 1.0).otherwise(1 - damping)).alias("score"))
    scores = propagate(edges, seeds, damping=damping, tolerance=tolerance, most_small=most_small)
    of = lambda kind: F.round(F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)), 6).alias(kind)
    scores = common.small(common.written(scores.groupBy("host").agg(of("trust"), of("distrust")), "host-scores"), most_small)
    rows = own.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    by_host = F.when((F.col("distrust") > threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    verdict = F.coalesce("_rule.verdict", by_host)
    return rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")
