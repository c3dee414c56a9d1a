"""Judge URLs by rules, and hosts without a rule by their links.

Trust spreads along links from hosts that the rules allow (personalised
PageRank), distrust against them from hosts that the rules block: who links
to a blocked host is suspect, by the share of its links that lead there, however
many others do the same. Only DataFrame functions are used. Links are
counted per pair of hosts before anything else, so a host with a third of all
pages is a few rows of the graph; sums are combined before their shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged

# (verdict, host and path prefix), for hosts and their subdomains.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
ITERATIONS = 30
# Share of the least distrust of a blocked seed from which a host is blocked.
SUSPECT = 0.25
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1])):
        cut = rule.index("/")
        fits = ((host == rule[:cut]) | host.endswith("." + rule[:cut])) & path.startswith(rule[cut:])
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts; ``pages`` has host and html."""
    found = pages.filter("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    return (found.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst"))
            .filter("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(kind, host, score) for kind 'trust' along the links and 'distrust' against them.

    ``seeds`` has kind and host; each seed starts with ``1 - damping``. A link
    passes on the share it has of its source's links, both ways: a host hands
    out its trust once, and takes distrust as far as it links to it, so the
    distrust that a blocked host gives does not shrink with its linkers. A step
    passes on what the last one has added, so hosts whose links are used up
    drop out; the steps end early only when nothing is left to pass on, as a
    small sum over all hosts says nothing about a single one.
    """
    # Written first: a join of two new shuffles splits a host with very many links.
    total = staged(links.groupBy("src").agg(F.sum("n").alias("total")), "host-totals")
    shares = links.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))
    ways = staged(shares.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "share").unionByName(
        shares.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "share")), "host-links")
    base = staged(seeds.select("kind", "host", F.lit(1.0 - damping).alias("score")), "host-seeds")
    added, steps = base, [base]
    for _ in range(iterations):
        passed = added.join(ways, ["kind", "host"]).select("kind", F.col("to").alias("host"), (
            damping * F.col("score") * F.col("share")).alias("score"))
        added = staged(passed.groupBy("kind", "host").agg(F.sum("score").alias("score")), "host-scores")
        if added.isEmpty():
            break
        steps.append(added)
    return reduce(DataFrame.unionByName, steps).groupBy("kind", "host").agg(F.sum("score").alias("score"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", damping: float = DAMPING, iterations: int = ITERATIONS,
               suspect: float = SUSPECT) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, trust, distrust``.

    A rule fits its host and all subdomains if the path starts with the
    rule's; the longest wins. Seeds are hosts of which more than half the
    pages are allowed, or blocked, by rule; a host that is only linked to is
    judged by the path "/". A page without a rule is blocked if its host has
    at least ``suspect`` of a seed's distrust and more distrust than trust,
    else allowed; so are pages without links to judge by, and pages with an
    empty host (null urls and urls without "://"). A null html has no links.
    Rows that repeat each give a row; other columns are ignored.
    """
    known = pages.select(
        pages[id_col].cast("bigint").alias("page_id"), host_of(pages[url_col]).alias("host"),
        path_of(pages[url_col]).alias("path"), pages[html_col].alias("html"))
    fitting = rule_of(F.col("host"), F.col("path"), rules)
    judged = staged(known.select("page_id", "host", "path", fitting.alias("found")).select(
        "page_id", "host", "path", "found.rule", "found.verdict"), "url-rules")
    links = staged(host_links(known), "host-pairs")

    share = {kind: F.sum((F.col("verdict") == verdict).cast("int")) * 2 > F.count("*")
             for kind, verdict in (("trust", "allow"), ("distrust", "block"))}
    own = judged.filter("host <> ''").groupBy("host").agg(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in share.items()])
    linked = links.select(F.col("dst").alias("host")).distinct().join(own.select("host"), "host", "left_anti")
    root = rule_of(F.col("host"), F.lit("/"), rules)["verdict"]
    linked = linked.select("host", *[F.coalesce(root == v, F.lit(False)).alias(k)
                                     for k, v in (("trust", "allow"), ("distrust", "block"))])
    hosts = own.unionByName(linked)
    seeds = hosts.filter("trust").select(F.lit("trust").alias("kind"), "host").unionByName(
        hosts.filter("distrust").select(F.lit("distrust").alias("kind"), "host"))

    scores = propagate(links, seeds, damping, iterations)
    score = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")}
    per_host = staged(scores.groupBy("host").agg(*score.values()), "host-verdicts")
    least = suspect * (1.0 - damping)
    blocked = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust"))
    return judged.join(per_host, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(blocked, "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
