"""URL filters: rules by host and path, and link-graph propagation for the other hosts.

Trust is a personalised PageRank from the hosts that the rules allow, along the links;
distrust is one from the hosts that they block, against the links: who links to blocked
hosts is distrusted. A host without rule is blocked if its distrust exceeds its trust.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import join_small

from .common import ascii_lower, materialize

DAMPING = 0.85
#: Steps are added until one moves less of the seeds' weight. Each moves DAMPING times the
#: last at most, so there are 57 at most.
TOLERANCE = 1e-4
#: A host is blocked if distrust > RATIO * trust.
RATIO = 1.0
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. rules: (verdict, host/path)."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, start = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, ``//host/`` ones among them; pages has
    host and ``html``."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"), F.lit(1))
    links = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(found).alias("url"))
    url = F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = links.select("src", host_of(url).alias("dst")).filter("dst <> '' AND src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, rank) from seeds (host, weight; weights of any sum) over edges (src, dst, n),
    to within ``tolerance``. What hosts without links hold returns to the seeds.

    So the rank is, up to a factor, the sum of what reaches a host from the seeds in 0, 1, 2
    ... steps, each damped: the steps are added up until one moves less than ``tolerance``."""
    total = seeds.agg(F.sum("weight")).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank")).limit(0)
    start = materialize(seeds.select("host", (F.col("weight") / total).alias("s")), "seeds")
    degree = edges.groupBy("src").agg(F.sum("n").alias("out"), F.count("*").alias("_n"))
    degree = materialize(degree, "degrees")
    share = join_small(edges, degree.select("src", "out"), "src", "inner", counts=lambda: degree.select("src", "_n"))
    share = materialize(share.select("src", "dst", (F.col("n") / F.col("out")).alias("w")), "shares")
    step = start.select("host", F.col("s").alias("rank"))
    whole, mass, total = step, 1.0, 1.0
    while mass >= tolerance:
        own = step.withColumnsRenamed({"host": "src"})
        moved = join_small(share, own, "src", "inner", counts=lambda: degree.select("src", "_n"))
        step = moved.groupBy(F.col("dst").alias("host")).agg((DAMPING * F.sum(F.col("rank") * F.col("w"))).alias("rank"))
        step = materialize(step, "step")
        mass = step.agg(F.sum("rank")).first()[0] or 0.0
        total += mass
        if mass:
            whole = whole.unionByName(step)
    return whole.groupBy("host").agg((F.sum("rank") / total).alias("rank"))


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with host, path, rule, trust, distrust and verdict (allow or block).

    A rule fits its host and the subdomains, where the path starts with the rule's; the
    longest decides. A null url, or one without ://, has an empty host and path: no rule,
    no links, allowed. Null html has no links. Repeated rows count as often as they
    stand. An empty table gives an empty result. A host of equal trust and distrust, none
    of either among them, is allowed. Input columns named like an output one, in any case,
    are replaced.
    """
    new = ("host", "path", "rule", "trust", "distrust", "verdict")
    kept = [c for c in pages.columns if c.lower() not in new]
    own = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = own.withColumns({"rule": rule, "verdict": verdict})
    hosts = own.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("_n"),
        F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocked"),
    )
    hosts = materialize(hosts, "hosts")
    edges = materialize(host_links(own, html), "links")
    trust = personalised_rank(edges, hosts.filter("allowed > 0").select("host", F.col("allowed").alias("weight")))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = personalised_rank(back, hosts.filter("blocked > 0").select("host", F.col("blocked").alias("weight")))
    scores = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
    found = join_small(own, scores, "host", "left", counts=lambda: hosts.select("host", "_n"))
    bad = F.coalesce("distrust", F.lit(0.0)) > RATIO * F.coalesce("trust", F.lit(0.0))
    return found.select(
        *kept, "host", "path", "rule",
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
    )
