"""URL rules, and verdicts from the link graph where no rule fits.

A rule is a host and the start of a path; it fits the host and its subdomains, and the
longest one that fits decides. The other pages go by their host: trust starts at hosts
with pages that rules allow and follows links; distrust starts at hosts with pages that
rules block and follows links backwards, to those who link there. Both are personalised
PageRanks over edges between hosts, each scaled to sum to one. A host whose distrust, less
its trust, exceeds ``EXCESS`` times its share of all pages is blocked, any other is allowed.

Edges are absolute and protocol-relative links from one host to another, each pair once,
and both ways between a host and the host it is a direct subdomain of, if both have pages.

Scale: pages become edges in a narrow pass and meet in map-side sums; each round is one
join on the host and one sum for both kinds of rank, and every few rounds are written to
the shared folder. Rounds go on until all that is still under way, of both kinds together, is
less than ``TOLERANCE`` of the share that the smallest host has to exceed, so links of any
depth count; one number comes to the driver each time. If ``rounds`` don't suffice, that is an error. A host with a
third of all pages is one row of the ranks. Ranks are rounded before they are compared, so
that the order of sums decides nothing.

Null urls and urls without ``://`` have an empty host and path, which no rule fits and
nothing links to: they are allowed. Null html has no links. Repeated rows count as pages.
Other columns are not looked at. Without pages of one kind of verdict, that rank is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

#: Fixed values: (host, start of path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING, EXCESS = 0.85, 0.5
#: What may be under way at the end, as a part of the smallest threshold, and the least that counts.
TOLERANCE, LEAST = 1e-3, 1e-12
#: Most rounds: after these ``DAMPING`` leaves less than ``LEAST``.
ROUNDS = 200
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, links) of every page; links are the hosts it names."""
    rest = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end")
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    split = pages.select("page_id", "html", F.coalesce(rest, F.lit("")).alias("rest")).withColumn("raw", host)
    path = F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), "^[^?#]*", 0)
    links = F.coalesce(F.regexp_extract_all("html", F.lit(LINK), 1), F.array().cast("array<string>"))
    return split.select("page_id", lower(F.col("raw")).alias("host"), path.alias("path"), links.alias("links"))


def ruled(rules=RULES) -> tuple[Column, Column]:
    """The rule that fits ``host`` and ``path``, and its verdict; both null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for host, path, result in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, result).otherwise(verdict)
    return name, verdict


def edges(judged: DataFrame) -> DataFrame:
    """(source, target): each pair of different hosts once."""
    named = judged.where("host <> '' and size(links) > 0").select("host", F.explode(F.array_distinct("links")).alias("link"))
    linked = named.select(F.col("host").alias("source"), lower(F.col("link")).alias("target")).distinct()
    hosts = judged.where("host <> ''").select("host").distinct()
    above = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("parent"))
    family = above.join(hosts.select(F.col("host").alias("parent")), "parent").select("host", "parent")
    every = linked.unionByName(family.toDF("source", "target")).unionByName(family.select(F.col("parent").alias("source"), F.col("host").alias("target")))
    return every.where("source <> target and target <> ''").distinct()


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, close: float = LEAST) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind of ``seeds(kind, host, mass)``.

    Trust follows ``links`` and distrust goes against them. What reaches a host without
    links is not passed on. A round passes on what the last one brought, ``fresh``; all that
    could still come is a geometric series of it, and ends the rounds when below ``close``.
    """
    both = links.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to")).unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"))
    )
    # Both sides of these joins are stored tables, so that the partition of a host which everybody links to can be split.
    out = written(both.groupBy("kind", "host").agg(F.count("*").alias("out")), "url-out")
    both = written(both.join(out, ["kind", "host"]), "url-edges")
    mass = (1 - damping) * F.col("mass")
    ranks = written(seeds.select("kind", "host", mass.alias("score"), mass.alias("fresh")), "url-seeds")
    for turn in range(1, rounds + 1):
        moved = ranks.where("fresh > 0").join(both, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.lit(damping) * F.col("fresh") / F.col("out")).alias("score"))
        known = ranks.select("kind", "host", "score", F.lit(0.0).alias("fresh"))
        ranks = known.unionByName(moved.withColumn("fresh", F.col("score"))).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("fresh").alias("fresh"))
        ranks = written(ranks, "url-ranks")
        left = (ranks.agg(F.sum("fresh")).first()[0] or 0.0) * damping / (1 - damping)
        if left <= close:
            return ranks.select("kind", "host", "score")
    raise ValueError(f"{left} of the mass is under way after {rounds} rounds, more than {close}")


def verdicts(pages: DataFrame, rules=RULES, excess: float = EXCESS, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    rule, decided = ruled(rules)
    judged = written(parts(pages).withColumn("rule", rule).withColumn("decided", decided), "url-pages")
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("decided") == "allow").alias("trust"), F.count_if(F.col("decided") == "block").alias("distrust")
    )
    hosts = written(hosts, "url-hosts")
    total = hosts.agg(*[F.sum(c).alias(c) for c in ("pages", "trust", "distrust")]).first()
    kinds = [
        hosts.where(f"host <> '' and {kind} > 0").select(F.lit(kind).alias("kind"), "host", (F.col(kind) / F.lit(total[kind] or 1)).alias("mass"))
        for kind in ("trust", "distrust")
    ]
    close = max(LEAST, TOLERANCE * excess / (total["pages"] or 1))
    ranks = propagate(edges(judged), kinds[0].unionByName(kinds[1]), damping, rounds, close)
    whole = {r.kind: r.whole for r in ranks.groupBy("kind").agg(F.sum("score").alias("whole")).collect()}
    share = F.col("score") / F.when(F.col("kind") == "trust", -whole.get("trust", 1.0)).otherwise(whole.get("distrust", 1.0))
    sums = ranks.groupBy("host").agg(F.sum(share).alias("bad"))
    scored = hosts.join(sums, "host", "left").select("host", F.round(F.coalesce("bad", F.lit(0.0)) - excess * F.col("pages") / F.lit(total["pages"] or 1), 12).alias("bad"))
    blocked = written(scored.where("bad > 0").select("host", F.lit(True).alias("blocked")), "url-blocked")
    out = judged.join(blocked, "host", "left")
    verdict = F.coalesce("decided", F.expr("case when blocked then 'block' else 'allow' end"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
