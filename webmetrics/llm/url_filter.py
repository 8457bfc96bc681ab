"""URL filters: host and path rules, and link-graph propagation for the rest.

Rules. A rule names a host and a path; it fits the host and all its subdomains where the
URL's path starts with the rule's. The longest fitting rule decides.

Propagation. Nodes are hosts, edges the links between different hosts found in the pages'
href and src attributes, weighted by their number. Two personalised PageRanks run side by
side over the same table of ranks: trust follows links from trusted seeds, distrust
follows them backwards from blocked seeds (who links to bad hosts is suspect). A host is
a seed of a side if more than half of its URLs have a rule of that side; a side's seeds
share its restart mass evenly. Ranks are given in multiples of one seed's restart mass,
so limits do not depend on the number of hosts. A URL without a rule is blocked if its
host's distrust reaches ``block_at`` and exceeds its trust.

Iterations are joins and pre-aggregated sums over host edges, written to the shared
folder every few rounds; they end when no rank moves by ``tolerance``, or when there is
no edge that a seed can reach.

Defined results: null URL or no ``://``: empty host and path, no rule, allowed; null or
empty html: no links; hosts known from links only take part; repeated rows count as
often as they come; no rules or no links: nothing propagates; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics.llm.blocks import written

#: The rules of the query: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY = 5        # rounds between written tables


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_verdict string, rule_host string, rule_path string")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds rule and rule_verdict to rows with host and path.

    An equal join of each host's own suffixes with the rules' hosts; the longest rule of a
    row is a pre-aggregated maximum."""
    r = rules.withColumn("rule", F.concat("rule_host", "rule_path"))
    pairs = urls.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = pairs.withColumn("rule_host", F.explode(suffix)).join(r, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("b"))
    best = best.select("host", "path", "b.rule", "b.rule_verdict")
    return urls.join(best, ["host", "path"], "left")


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    raw = F.regexp_extract_all(F.coalesce(F.col(f"`{html}`"), F.lit("")), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), F.lit(1))
    link = pages.select(host_of(F.col(f"`{url}`")).alias("src"), F.explode(raw).alias("u"))
    dst = host_of(F.when(F.col("u").startswith("//"), F.concat(F.lit("x:"), F.col("u"))).otherwise(F.col("u")))
    return link.select("src", dst.alias("dst")).where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagated(seeds: DataFrame, links: DataFrame, damping: float = 0.85, rounds: int = 30, tolerance: float = 1e-4) -> DataFrame:
    """(host, trust, distrust) from seeds (side, host), in multiples of a seed's restart mass."""
    forth = links.select(F.lit("trust").alias("side"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    back = links.select(F.lit("distrust").alias("side"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    edges = forth.unionByName(back)
    out = edges.groupBy("side", "host").agg(F.sum("n").alias("all"))
    edges = written(edges.join(out, ["side", "host"]).select("side", "host", "to", (F.col("n") / F.col("all")).alias("part")), "host-edges")
    seeds = written(seeds.select("side", "host").distinct(), "seeds")
    start = seeds.withColumn("rank", F.lit(1.0))
    rank, before = start, start
    reach = bool(edges.join(seeds, ["side", "host"], "left_semi").take(1))
    for i in range(rounds if reach else 0):
        flow = rank.join(edges, ["side", "host"]).groupBy("side", F.col("to").alias("host")).agg(F.sum(F.col("rank") * F.col("part")).alias("rank"))
        rank = _next(start, flow, damping)
        if i % EVERY == EVERY - 1:
            rank = written(rank, "ranks")
            moved = rank.join(before.withColumnRenamed("rank", "old"), ["side", "host"], "left")
            if not moved.where(F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0))) > tolerance).take(1):
                break
            before = rank
    return rank.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("side") == s, F.col("rank"))), F.lit(0.0)).alias(s) for s in ("trust", "distrust")])


def _next(start: DataFrame, flow: DataFrame, damping: float) -> DataFrame:
    """Restart (one each, on the seeds) plus the damped flow."""
    both = start.unionByName(flow.select("side", "host", (F.col("rank") * F.lit(damping)).alias("rank")))
    return both.groupBy("side", "host").agg(F.sum("rank").alias("rank"))


def judged(pages: DataFrame, rules: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html",
           block_at: float = 0.1, damping: float = 0.85, rounds: int = 30) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust, distrust."""
    c = F.col(f"`{url}`")
    urls = pages.select(F.col(f"`{ident}`").alias("id"), host_of(c).alias("host"), path_of(c).alias("path"))
    got = ruled(urls, rules)
    hosts = got.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("rule_verdict") == v, 1)).alias(v) for v in ("allow", "block")])
    side = F.when(F.col("allow") * 2 > F.col("n"), "trust").when(F.col("block") * 2 > F.col("n"), "distrust")
    seeds = hosts.select(side.alias("side"), "host").where("side is not null")
    ranks = propagated(seeds, host_links(pages, url, html), damping, rounds)
    out = got.join(ranks, "host", "left").withColumns({s: F.coalesce(s, F.lit(0.0)) for s in ("trust", "distrust")})
    bad = (F.col("distrust") >= block_at) & (F.col("distrust") > F.col("trust"))
    verdict = F.coalesce(F.col("rule_verdict"), F.when(bad, "block").otherwise("allow"))
    return out.select(F.col("id").alias(ident), "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: the four rules and propagation over ``pages``."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")
