"""URL filter: prefix rules first, then trust and distrust spread over the graph of hosts.

A rule (host, path) fits a host and its subdomains where the path starts with the rule's; the longest
fitting rule decides. Pages without one are judged by host: personalised PageRank spreads trust
from hosts with allowed pages along host edges, and distrust from hosts with blocked pages against
them. A host is blocked if its distrust exceeds LEAST_DISTRUST, and MARGIN times its trust. Host edges: links to
other hosts in the page's html, and both ways between each host, its parent domain, that one's
parent and so on down to two labels, with or without pages (names under one domain are run together). A host shares its rank equally among its neighbours.

Ranks are plain joins and aggregates over (host, host) edges, settled after every few rounds; a host with a
third of all pages or links is combined before the shuffle. ROUNDS rounds are made on any graph: each takes the
distance to the settled ranks, summed over all hosts, to DAMPING of what it was, so less than TOLERANCE is left then.
What a host without neighbours would pass on is lost; it keeps its seed. Very long urls are hosts and paths like others. Null urls, or urls without ``://``: host and
path are empty, no rule, allowed. Null html has no links. Repeated rows are each answered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import settle
from energy_mart.session import release

#: Verdict and prefix (host, then path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
DAMPING, LEAST_DISTRUST, MARGIN, TOLERANCE = 0.85, 1e-9, 1.01, 1e-4
#: Ranks sum to 1, so two of them are 2 apart at most. ROUNDS_A_STEP rounds are one settled table.
ROUNDS, ROUNDS_A_STEP = math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING)), 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule (struct of rule and verdict), or null."""
    out = None
    for verdict, prefix in sorted(rules, key=lambda r: -len(r[1])):
        name, _, start = prefix.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        answer = F.struct(F.lit(prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, answer) if out is None else out.when(fits, answer)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) of different hosts; ``pages`` has host and html."""
    links = F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda h: F.translate(h, _UPPER, _LOWER))
    linked = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(links)).alias("dst"))
    known = pages.select("host").unionByName(linked.select(F.col("dst").alias("host"))).distinct()
    labels = F.split("host", r"\.")
    levels = F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2))
    upper = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    chain = F.transform(levels, lambda i: F.struct(upper(i).alias("host"), upper(i + 1).alias("parent")))
    kin = known.select(F.explode(chain).alias("k")).select("k.*").filter(F.col("host").rlike(r"^[^.]+\.[^.]+\..+$")).distinct()
    both = kin.select(F.col("host").alias("src"), F.col("parent").alias("dst")).unionByName(kin.select(F.col("parent").alias("src"), F.col("host").alias("dst")))
    return linked.unionByName(both).filter("src <> '' AND dst <> '' AND src <> dst").distinct()


def ranks(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust): ranks personalised on ``seeds`` (host, trusted, blocked weights)."""
    forward = edges.select(F.lit("trust").alias("kind"), "src", "dst")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    directed = forward.unionByName(back)
    shares = directed.groupBy("kind", "src").agg((F.lit(1.0) / F.count(F.lit(1))).alias("share"))
    moves = settle(directed.join(shares, ["kind", "src"]))
    total = seeds.agg(F.sum("trusted").alias("t"), F.sum("blocked").alias("b")).first()
    kinds = F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("trusted") / (total["t"] or 1.0)).alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("blocked") / (total["b"] or 1.0)).alias("seed")),
    )
    start = settle(seeds.select("host", F.explode(kinds).alias("k")).select("host", "k.*").filter("seed > 0"))
    kept = start.select("host", "kind", ((1 - DAMPING) * F.col("seed")).alias("rank"))
    now = start.withColumnRenamed("seed", "rank")
    held = None
    for done in range(1, rounds + 1):
        sent = moves.join(now.withColumnRenamed("host", "src"), ["kind", "src"])
        given = sent.select(F.col("dst").alias("host"), "kind", (DAMPING * F.col("rank") * F.col("share")).alias("rank"))
        now = given.unionByName(kept).groupBy("host", "kind").agg(F.sum("rank").alias("rank"))
        if done % ROUNDS_A_STEP == 0 or done == rounds:
            now = settle(now)
            if held is not None:
                release(held)
            held = now
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return now.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    host, path = host_and_path(F.col("url"))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"), "html").withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    edges = settle(host_edges(placed.select("host", "html")))
    own = placed.drop("html")
    given = lambda verdict: F.avg((F.coalesce(F.col("found.verdict"), F.lit("")) == verdict).cast("double"))
    seeds = settle(own.filter("host <> ''").groupBy("host").agg(given("allow").alias("trusted"), given("block").alias("blocked")))
    spread = ranks(edges, seeds)
    # A host with very many pages: AQE cuts the pages' side of its partition.
    joined = own.join(settle(spread), "host", "left")
    doubtful = (F.col("distrust") > LEAST_DISTRUST) & (F.col("distrust") > MARGIN * F.col("trust"))
    method = F.when(F.coalesce(doubtful, F.lit(False)), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict"))
