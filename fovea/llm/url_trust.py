"""Operator 5: allow and block rules for URLs, and trust that spreads over links between hosts.

Rules decide about the pages they fit. For the others the host decides: hosts of allowed pages are
trusted seeds, hosts of blocked ones distrusted seeds. Trust is a personalised PageRank from the
trusted seeds along links; distrust one from the blocked seeds against them, since whoever links
to a bad host is suspect. A host is blocked if its distrust exceeds `threshold` times its trust (by more
than rounding).

Links are those of the pages' HTML to other hosts, and between every domain above a host and the one above that,
down to two labels (links of a site to itself name no host). They are added up per pair of hosts before any
join, and both walks run as one. Ranks start at the seeds' own share and only grow from turn to turn,
by all ways one link longer; the walk ends when a number of turns adds less than `tolerance` to the
sum of all ranks and reaches no host that had none, however far that is. Main path: DataFrame functions only.

Defined cases: a URL that is null or has no `://` has an empty host and path, no rule, and the
verdict of a host without evidence, allow; null HTML has no links; hosts that only links name
carry trust but have no row; a name longer than a host's may be has no domains above it; a null id is kept; repeated rows are judged each; other columns are
ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import materialize

#: (verdict, host, path); the longest rule that fits wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING, TOLERANCE, THRESHOLD = 0.6, 1e-7, 1.0
#: Fixed value: characters of the longest name that a host may have; longer ones have no domains above.
LONGEST_HOST = 253
#: Turns between two looks at how much the ranks grew; what they made is then written.
TURNS = 4
#: Links that a task of a turn takes: few hosts are not spread over many tasks.
LINKS_PER_TASK = 1_000_000
LINKS = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def small(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.coalesce(small(host), F.lit("")), F.coalesce(path, F.lit(""))


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, ruled): the longest rule that fits, and its verdict."""
    host, path = host_and_path()
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fit = fits(F.col("host"), F.col("path"), rule_host, rule_path)
        rule = F.when(fit, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fit, F.lit(what)).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("ruled", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, links): links between different hosts, and with the domains above, each way."""
    host, _ = host_and_path()
    targets = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINKS), 1)
    targets = F.array_distinct(F.transform(targets, small))
    rows = pages.select(host.alias("source"), targets.alias("targets"))
    linked = rows.select("source", F.explode("targets").alias("target"))
    linked = linked.groupBy("source", "target").agg(F.count("*").alias("links"))
    linked = materialize(linked, "named-hosts")  # read twice; the HTML is read once
    hosts = rows.select("source").union(linked.select("target")).distinct()
    labels = F.split("source", r"\.")
    levels = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    # from the host itself to its last two labels, each with the next one
    steps = F.arrays_zip(
        F.slice(levels, 1, F.size(levels) - 1).alias("source"), F.slice(levels, 2, F.size(levels)).alias("target")
    )
    hosts = hosts.where((F.length("source") <= LONGEST_HOST) & (F.size(labels) > 2))
    above = hosts.select(F.inline(steps).alias("source", "target")).distinct()
    above = above.withColumn("links", F.lit(1))
    below = above.select(F.col("target").alias("source"), F.col("source").alias("target"), "links")
    edges = linked.unionByName(above).unionByName(below)
    edges = edges.where((F.col("source") != F.col("target")) & (F.col("source") != "") & (F.col("target") != ""))
    return edges.groupBy("source", "target").agg(F.sum("links").alias("links"))


def spread(
    links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """(host, trust, distrust) from (source, target, links) and (host, trusted, blocked) seed weights.

    One table holds both walks, told apart by `walk`: 0 along links, 1 against them. Rank that
    reaches a host without onward links goes no further.
    """
    either = F.array(
        F.struct(F.lit(0).alias("walk"), F.col("source").alias("host"), F.col("target").alias("to")),
        F.struct(F.lit(1).alias("walk"), F.col("target").alias("host"), F.col("source").alias("to")),
    )
    links = materialize(links, "host-links")
    tasks = -(-links.count() // LINKS_PER_TASK) or 1
    steps = links.select("links", F.inline(either))
    out = steps.groupBy("walk", "host").agg(F.sum("links").alias("total"))
    steps = steps.join(out, ["walk", "host"]).select(
        "walk", "host", "to", (F.col("links") / F.col("total") * damping).alias("part")
    )
    steps = materialize(steps.coalesce(tasks), "host-steps")
    start = seeds.select(
        "host",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("walk"), F.col("trusted").alias("rank")),
                F.struct(F.lit(1).alias("walk"), F.col("blocked").alias("rank")),
            )
        ),
    ).where("rank > 0")
    total = start.groupBy("walk").agg(F.sum("rank").alias("total"))
    start = start.join(F.broadcast(total), "walk").select(  # two rows
        "walk", "host", (F.col("rank") / F.col("total") * (1 - damping)).alias("rank")
    )
    start = materialize(start, "host-seeds")
    ranks, before = start, start.agg(F.sum("rank").alias("rank"), F.count("*").alias("hosts")).first()
    while True:
        for _ in range(TURNS):
            moved = ranks.join(steps, ["walk", "host"]).select(
                "walk", F.col("to").alias("host"), (F.col("rank") * F.col("part")).alias("rank")
            )
            ranks = moved.unionByName(start).groupBy("walk", "host").agg(F.sum("rank").alias("rank"))
            ranks = ranks.coalesce(tasks)
        ranks = materialize(ranks, "host-ranks")  # a hub's links can be split, lineage is cut
        now = ranks.agg(F.sum("rank").alias("rank"), F.count("*").alias("hosts")).first()
        grown = (now["rank"] or 0.0) - (before["rank"] or 0.0)
        if now["hosts"] == before["hosts"] and grown <= tolerance:
            break
        before = now
    ranks = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("walk") == 0, F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("walk") == 1, F.col("rank")).otherwise(0.0)).alias("distrust"),
    )
    return materialize(ranks, "host-ranks")


def judge(
    pages: DataFrame,
    rules=RULES,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    ruled = with_rules(pages, rules)
    seeds = ruled.where("rule is not null").groupBy("host").agg(
        F.sum((F.col("ruled") == "allow").cast("double")).alias("trusted"),
        F.sum((F.col("ruled") == "block").cast("double")).alias("blocked"),
    )
    hosts = spread(host_links(pages), seeds, damping, tolerance)
    rows = ruled.join(hosts, "host", "left")
    trust, distrust = (F.coalesce(x, F.lit(0.0)) for x in ("trust", "distrust"))
    own = F.when(distrust > threshold * (1 + 1e-9) * trust, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
