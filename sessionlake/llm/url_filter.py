"""URL filter: rules on host and path, and link-graph propagation for the rest.

Rules (host, path) fit a host and its subdomains when the url's path starts with
the rule's; the longest rule wins. Where none fits, the host's verdict holds:
trust flows from hosts with allowed pages along host edges, distrust flows from
hosts with blocked pages against them (personalised PageRank, once forward and
once reversed), and a host is blocked when distrust outweighs trust.

Host edges, weighted by the number of links: links of a page's HTML that name
another host, and (weight 1, both ways) a host and the domain right above it
when both have pages or links. Links within a host move nothing between hosts.
A host's seed weight is the share of its rule-decided pages that are allowed
(or blocked). Hosts without outgoing edges hand their rank back to the seeds.

The graph lives in Spark: links are counted per pair of hosts before the
shuffle, a round is one join and one aggregation over all edges, and state is
cut every ROUNDS_A_CUT rounds. A round shrinks the error by the damping factor,
so the loop ends when rounds hardly move rank any more, and by the round where
the error must be below TOLERANCE in any case.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and the verdict of an unreached host; hosts that neither trust nor
distrust reaches are allowed, as are ties. Null html has no links. Repeated
pages and ids are judged row by row (and their links count each). An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import ascii_lower, cut

#: (verdict, host, path), in the order of the contract.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
DAMPING = 0.85
TOLERANCE = 1e-4
ROUNDS_A_CUT = 6
#: Distrust must be more than this share of trust and distrust.
THRESHOLD = 0.5
#: A link in HTML that names a host: ``href`` with an absolute or ``//`` address.
LINK = r"(?i)\bhref\s{0,9}=\s{0,9}[\"']?\s{0,9}(?:[a-z][a-z0-9+.-]{0,31}:)?//([^/?#\"'<>\s]+)"


def host_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(ascii_lower(F.regexp_extract(after, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, h, p = rule
    return ((host == h) | host.endswith("." + h)) & path.startswith(p)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The winning rule as text and its verdict; null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = _fits(host, path, r)
        text, verdict = F.when(fits, F.lit(r[1] + r[2])).otherwise(text), F.when(fits, F.lit(r[0])).otherwise(verdict)
    return text, verdict


def judged_by_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, by_rule`` of every page."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("by_rule"))


def links(pages: DataFrame) -> DataFrame:
    """``src, dst, w``: links between different hosts, counted per pair."""
    found = pages.select(host_of(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    return (found.select("src", ascii_lower(F.col("dst")).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w")))


def parents(hosts: DataFrame) -> DataFrame:
    """A host and the host right above it, both ways, where both exist."""
    up = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("above")).filter("above <> ''")
    both = up.join(hosts.select(F.col("host").alias("above")), "above")
    return (both.select(F.col("host").alias("src"), F.col("above").alias("dst"), F.lit(1.0).alias("w"))
            .unionByName(both.select(F.col("above").alias("src"), F.col("host").alias("dst"), F.lit(1.0).alias("w"))))


def host_scores(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``host, trust, distrust`` of the hosts that either reaches. ``seeds(host,
    good, bad)`` holds seed weights, ``edges(src, dst, w)`` links.

    Handing the rank of hosts without edges back to the seeds only scales the
    solution of y = seeds + damping * flow(y). That sum is built without it,
    round by round, and scaled at the end. All its terms are positive, so the
    growth of the total tells how far the rounds still move."""
    kinds = ("trust", "distrust")
    edges = cut(edges.groupBy("src", "dst").agg(F.sum("w").alias("w")))
    out_w = edges.groupBy("src").agg(F.sum("w").alias("of"))
    in_w = edges.groupBy("dst").agg(F.sum("w").alias("of"))
    zero = F.lit(0.0)
    # Trust goes along an edge, distrust against it; one table serves both.
    flow = cut(edges.join(out_w, "src").select("src", "dst", (damping * F.col("w") / F.col("of")).alias("f_trust"), zero.alias("f_distrust"))
               .unionByName(edges.join(in_w, "dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), zero.alias("f_trust"),
                                                           (damping * F.col("w") / F.col("of")).alias("f_distrust"))))
    start = cut(seeds.filter("good > 0 OR bad > 0").select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust")))
    sums = lambda df: tuple(x or 0.0 for x in df.agg(*[F.sum(k) for k in kinds]).first())
    weight, state = sums(start), start
    total, done, last = weight, 0, math.ceil(math.log(tolerance / 2) / math.log(damping))
    while done < last:
        rounds = min(ROUNDS_A_CUT, last - done)
        for _ in range(rounds):
            came = (flow.join(state.withColumnRenamed("host", "src"), "src")
                    .select(F.col("dst").alias("host"), *[(F.col(k) * F.col(f"f_{k}")).alias(k) for k in kinds]))
            state = start.unionByName(came).groupBy("host").agg(*[F.sum(k).alias(k) for k in kinds])
        state, before = cut(state), total
        total, done = sums(state), done + rounds
        if all(t - b <= tolerance * (1 - damping) * t for t, b in zip(total, before)):
            break
    # Shares of the rank, times the weight of the seeds they came from.
    scale = [w / t if t else 0.0 for w, t in zip(weight, total)]
    return state.select("host", *[(F.col(k) * s).alias(k) for k, s in zip(kinds, scale)])


def host_verdicts(pages: DataFrame, ruled: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``host, trust, distrust, verdict`` of every host that rank reaches."""
    linked = cut(links(pages))
    own = ruled.filter("host <> ''").groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("a"),
                                                         F.count_if(F.col("by_rule") == "block").alias("b"))
    both = F.col("a") + F.col("b")
    share = lambda c: F.when(both > 0, F.col(c) / both).otherwise(0.0)
    seeds = cut(own.select("host", share("a").alias("good"), share("b").alias("bad")))
    hosts = seeds.select("host").unionByName(linked.select(F.explode(F.array("src", "dst")).alias("host"))).distinct()
    scores = host_scores(seeds, linked.unionByName(parents(hosts)), damping, tolerance)
    # a tie must not hang on the last bit of a sum
    blocked = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")) * (1 + 1e-9)
    return scores.select("*", F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every page with its host, path, winning rule and verdict."""
    ruled = judged_by_rule(pages, rules)
    hosts = host_verdicts(pages, ruled).select("host", F.col("verdict").alias("by_host"), "trust", "distrust")
    return ruled.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"), "trust", "distrust")
