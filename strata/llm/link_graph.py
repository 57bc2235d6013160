"""URL filter: rules first, then trust and distrust propagated over the hosts' link graph.

Edges lead from a page's host to the host of each absolute link in its HTML;
besides, a host of four labels or more and its parent (without the first
label) are linked both ways.  Trust is personalised PageRank from the trusted
seeds along the edges, distrust the same from the blocked seeds along the
reversed edges: who links to blocked hosts shares their distrust.  Seeds are
all hosts with pages that a rule allows or blocks, weighted by the share of
these pages; a host with both is a seed of both.
A host is blocked if its distrust is over ``ratio`` times its trust and at
least ``least`` times the mean host's.

DataFrame functions only.  Edges are counted per host pair before anything
else, and ranks are written each round, so that plans stay short.

Results: a null url, or one without ``://``, has an empty host and path, fits
no rule and is allowed; a null html has no links; repeated rows each give
their own row (their links count once); a null page id stays null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

DAMPING, ROUNDS = 0.85, 12
RATIO, LEAST = 2.0, 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains if the url's path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null.  ``rules`` is a short list."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of a host that link to another host, and parents."""
    linked = (pages.select("host", F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(LINK), F.lit(1)),
        lambda x: host_of(F.concat(F.lit("x:"), F.regexp_replace(x, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""))))))
        .alias("dst")).filter("host <> '' and dst <> '' and host <> dst")
        .groupBy(F.col("host").alias("src"), "dst").agg(F.count("*").cast("double").alias("weight")))
    hosts = pages.select("host").filter(F.size(F.split("host", r"\.")) >= 4).distinct()
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    up = hosts.select(F.col("host").alias("src"), parent.alias("dst"), F.lit(1.0).alias("weight"))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return (linked.unionByName(up).unionByName(down)
            .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, rank) from seeds (kind, host, share); shares and ranks of a kind sum to one.

    ``edges`` has kind, src, dst, share (shares of a source sum to one).  Rank of a host without edges goes back
    to the seeds.
    """
    ranks = _written(seeds.select("kind", "host", F.col("share").alias("rank")), "ranks")
    for _ in range(rounds):
        moved = (ranks.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
                 .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("rank")))
        moved = _written(moved, "moved")
        total = moved.groupBy("kind").agg(F.sum("rank").alias("kept"))              # two rows
        back = (seeds.join(F.broadcast(total), "kind", "left")
                .select("kind", "host", (F.col("share") * (1 - damping * F.coalesce("kept", F.lit(0.0)))).alias("rank")))
        ranks = _written(moved.withColumn("rank", damping * F.col("rank")).unionByName(back)
                         .groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "ranks")
    return ranks


def judge(pages: DataFrame, rules: list[Rule] = RULES, ratio: float = RATIO, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages`` (page_id, url, html), with trust and distrust."""
    url = F.col("url")
    seen = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                        F.coalesce("html", F.lit("")).alias("html"))
    seen = seen.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    edges = _written(host_edges(seen), "host-edges")
    is_ = lambda v: F.avg(F.when(F.col("found.verdict") == v, 1.0).otherwise(0.0))
    hosts = _written(seen.filter("host <> ''").groupBy("host").agg(is_("allow").alias("allow"), is_("block").alias("block")),
                     "hosts")
    both = edges.withColumn("kind", F.lit("trust")).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit("distrust").alias("kind")))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    both = _written(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total"))
                                                           .alias("share")), "shares")
    seeds = hosts.filter("allow > 0").select(F.lit("trust").alias("kind"), "host", F.col("allow").alias("w")).unionByName(
        hosts.filter("block > 0").select(F.lit("distrust").alias("kind"), "host", F.col("block").alias("w")))
    sums = seeds.groupBy("kind").agg(F.sum("w").alias("total"))                      # two rows
    seeds = _written(seeds.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("w") / F.col("total"))
                                                                  .alias("share")), "seeds")
    ranks = propagate(both, seeds)
    rank = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    by_host = ranks.groupBy("host").agg(rank("trust").alias("trust"), rank("distrust").alias("distrust"))
    n = hosts.agg(F.count("*").alias("n_hosts"))
    by_host = _written(by_host.join(F.broadcast(n)), "judged")                       # n is one row
    distrust, trust = F.coalesce("distrust", F.lit(0.0)), F.coalesce("trust", F.lit(0.0))
    blocked = (distrust > ratio * trust) & (distrust * F.coalesce("n_hosts", F.lit(0)) >= least)
    return seen.drop("html").join(by_host, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))
