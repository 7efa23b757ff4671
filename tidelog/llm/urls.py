"""URL filters: rules by host and path, and trust carried along the links between hosts for what no rule decides.

A rule fits its host and all subdomains where the path starts with the rule's path; the longest fitting rule wins. Every
address that is met (of a page, or as a link on one) is judged by the rules. A host is a trusted seed by the share of its
addresses that a rule allows and a blocked seed by the share that a rule blocks. Trust goes from a host to those it links
to, distrust goes back from a host to those that link to it, both as personalised PageRank over host edges:
score = (1 - DAMPING) * seed + DAMPING * what the neighbours send, each neighbour dealing its score out by its number of
links. A host with more than RATIO times as much distrust as trust is blocked. Links inside a host carry nothing.

Only DataFrame functions are used. The pages are reduced to host edges with a map-side count in one scan; each step joins
the edges with the scores (one row per host) and adds up by receiver, and is written before the next one.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed; a null html has
no links; an empty host is no part of the graph; a host without rules, links or evidence is allowed; rules of one length
are tried longest host first, then by name; rows that repeat count as often as they occur; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored

# Production parameters. Rules: (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
RATIO = 1.0
STEPS = 50  # at most; fewer once a step adds less than TOLERANCE of what there is
TOLERANCE = 1e-9
DIGITS = 10  # scores are compared to so many decimals, as sums may differ in the last bits

ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^\s"'<>]+)"""


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), ADDRESS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), ADDRESS, 2)


def _longest_first(rules) -> list[tuple[str, str, str, str]]:
    """(host, path, rule, verdict) in the order in which they are tried."""
    split = [(rule.partition("/")[0], "/" + rule.partition("/")[2], rule, verdict) for verdict, rule in rules]
    return sorted(split, key=lambda r: (-len(r[2]), -len(r[0]), r[2]))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of rule and verdict of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, rule, verdict in reversed(_longest_first(rules)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _judged(addresses: DataFrame, rules) -> DataFrame:
    """Rows with url gain host, path, rule and ruling."""
    named = addresses.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = named.withColumn("_found", rule_of(F.col("host"), F.col("path"), rules))
    return found.withColumns({"rule": F.col("_found.rule"), "ruling": F.col("_found.verdict")}).drop("_found")


def _links(pages: DataFrame, rules) -> DataFrame:
    """Links with an authority, counted by the page's host, the host they lead to, and the ruling on them."""
    found = F.regexp_extract_all("html", F.lit(LINK), F.lit(1))
    links = pages.select(host_of(F.col("url")).alias("from"), F.explode(found).alias("url"))
    whole = F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), F.col("url"))).otherwise(F.col("url"))
    judged = _judged(links.withColumn("url", whole), rules)
    return judged.groupBy("from", F.col("host").alias("to"), "ruling").agg(F.count("*").alias("n"))


def seeds(pages: DataFrame, links: DataFrame, rules=RULES) -> DataFrame:
    """(kind, host, seed): how far each host is a trusted and a blocked seed; only where it is."""
    own = _judged(pages.select("url"), rules).groupBy("host", "ruling").agg(F.count("*").alias("n"))
    met = own.unionByName(links.select(F.col("to").alias("host"), "ruling", "n")).filter(F.col("host") != "")

    def share(verdict: str) -> Column:
        return F.sum(F.when(F.col("ruling") == verdict, F.col("n")).otherwise(0)) / F.sum("n")

    shares = met.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    both = F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust")))
    return shares.select("host", both.alias("kind", "seed")).filter(F.col("seed") > 0).select("kind", "host", "seed")


def _edges(links: DataFrame) -> DataFrame:
    """(kind, from, to, share): along links for trust, against them for distrust; the shares of a sender add up to 1."""
    hosts = links.filter((F.col("from") != F.col("to")) & (F.col("from") != "") & (F.col("to") != ""))
    hosts = hosts.groupBy("from", "to").agg(F.sum("n").alias("n"))
    along = hosts.select(F.lit("trust").alias("kind"), "from", "to", "n")
    against = hosts.select(F.lit("distrust").alias("kind"), F.col("to").alias("from"), F.col("from").alias("to"), "n")
    both = along.unionByName(against)
    sent = both.groupBy("kind", "from").agg(F.sum("n").alias("all"))
    return both.join(sent, ["kind", "from"]).select("kind", "from", "to", (F.col("n") / F.col("all")).alias("share"))


def propagated(start: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(kind, host, score): personalised PageRank from the seeds. Scores only grow, so their sum tells when to stop."""
    own = start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"))
    scores, total = own, own.agg(F.sum("score")).first()[0] or 0.0
    for _ in range(steps):
        sent = edges.join(scores.withColumnRenamed("host", "from"), ["kind", "from"])
        sent = sent.select("kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
        scores = stored(own.unionByName(sent).groupBy("kind", "host").agg(F.sum("score").alias("score")), "url-scores")
        before, total = total, scores.agg(F.sum("score")).first()[0] or 0.0
        if total - before <= TOLERANCE * total:
            break
    return scores


def blocked_hosts(pages: DataFrame, rules=RULES, damping: float = DAMPING, ratio: float = RATIO) -> DataFrame:
    """(host, trust, distrust) of the hosts that carry too much distrust."""
    links = stored(_links(pages, rules), "url-links")
    start = stored(seeds(pages, links, rules), "url-seeds")
    scores = propagated(start, stored(_edges(links), "url-edges"), damping)

    def score(kind: str) -> Column:
        return F.round(F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)), DIGITS)

    by_host = scores.groupBy("host").agg(score("trust").alias("trust"), score("distrust").alias("distrust"))
    return by_host.filter(F.col("distrust") > F.col("trust") * ratio)


def url_report(pages: DataFrame, rules=RULES, damping: float = DAMPING, ratio: float = RATIO) -> DataFrame:
    """Per page (page_id, url, html): page_id, host, path, rule (null if none fits), verdict."""
    blocked = blocked_hosts(pages, rules, damping, ratio).select("host", F.lit("block").alias("_by_links"))
    judged = _judged(pages.select("page_id", "url"), rules).drop("url")
    told = judged.join(stored(blocked, "url-blocked"), "host", "left")
    verdict = F.coalesce("ruling", "_by_links", F.lit("allow"))
    return told.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
