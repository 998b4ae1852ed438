"""URL filter: rules first, then trust and distrust spread over the graph of hosts.

A rule names a host and a path; it fits the host and its subdomains if the url's
path starts with the rule's, the longest rule decides. Hosts with allowed pages
are the seeds of a personalised PageRank along links (trust), hosts with blocked
pages those of one against the links (distrust), each weighted by those pages, so
a host that links to blocked hosts is distrusted and a host with both kinds of
pages is a seed of both. A url without a rule is blocked if its host's distrust
exceeds ``ratio`` times its trust, else allowed.

Link counts are combined in each task before they are shuffled, so a host with a
third of all pages or links is a handful of rows. Each round of the walk is one
join and one sum; walks that reach a host without links end there. Rounds go on
until no host's trust or distrust changes by more than a share of itself, however
small it is; both are given to twelve significant digits.

Defined results: a null url or one without ``://`` has empty host and path, no
rule and is allowed; a null html has no links; links inside a host don't count;
repeated pages count as often as they occur; an empty table gives no rows; other
columns are passed through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The list of the registered query (fixed values).
RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


@dataclass(frozen=True)
class Walk:
    """``damping``: chance to go on; ``rounds``: fixed number of rounds, else until no rank changes by more than
    ``tolerance`` times itself; ``written_every``: rounds between written ranks, which are compared."""

    damping: float = 0.85
    rounds: int | None = None
    tolerance: float = 1e-6
    written_every: int = 4
    ratio: float = 1.0


RESULTS = ("host", "path", "rule", "trust", "distrust", "verdict")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``__rule_verdict`` (both null where no rule fits)."""
    named = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is asked first
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return named.withColumns({"rule": rule, "__rule_verdict": verdict})


def host_links(pages: DataFrame) -> DataFrame:
    """Number of links from host ``src`` to another host ``dst``."""
    pattern = "(?i)\\bhref\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s<>]+)"
    targets = F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(pattern), 1))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    links = links.select("src", F.translate("dst", _UPPER, _UPPER.lower()).alias("dst")).where("src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def seeds(judged: DataFrame) -> DataFrame:
    """Share of a host in all pages that rules allow (``trust``) or block (``distrust``)."""
    kind = F.when(F.col("__rule_verdict") == "allow", "trust").otherwise("distrust")
    marked = judged.where("host <> '' AND __rule_verdict IS NOT NULL").groupBy(kind.alias("kind"), "host").agg(F.count(F.lit(1)).alias("pages"))
    totals = {r[0]: r[1] for r in marked.groupBy("kind").agg(F.sum("pages")).collect()}  # two rows at most
    share = F.lit(None).cast("double")
    for name, total in totals.items():
        share = F.when(F.col("kind") == name, F.col("pages") / float(total)).otherwise(share)
    return marked.select("kind", "host", share.alias("seed"))


def settled(before: DataFrame, now: DataFrame, tolerance: float) -> bool:
    """Whether both tables have the same hosts and no rank changed by more than its share."""
    old = before.withColumnRenamed("rank", "old")
    moved = F.abs(F.col("rank") - F.col("old")) > F.col("rank") * tolerance + 1e-300  # below, doubles have no digits left to settle
    return now.join(old, ["kind", "host"], "full").where(F.coalesce(moved, F.lit(True))).isEmpty()


def propagate(links: DataFrame, start: DataFrame, stages: Stages, walk: Walk = Walk()) -> DataFrame:
    """host, trust and distrust at the end of both walks, which run side by side."""
    forward = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "links")
    back = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "links")
    steps = forward.unionByName(back)
    out = steps.groupBy("kind", "host").agg(F.sum("links").alias("all"))
    steps = steps.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("all")).alias("chance"))
    steps = stages.write(steps, "steps")
    start = stages.write(start, "seeds")
    again = start.select("kind", "host", (F.col("seed") * (1 - walk.damping)).alias("rank"))
    ranks = written = start.select("kind", "host", F.col("seed").alias("rank"))
    done = 0
    while walk.rounds is None or done < walk.rounds:
        came = ranks.join(steps, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (F.col("rank") * F.col("chance") * walk.damping).alias("rank")
        )
        ranks = came.unionByName(again).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        done += 1
        if done % walk.written_every == 0 or done == walk.rounds:
            before, ranks = written, stages.write(ranks, "ranks")
            written = ranks
            if walk.rounds is None and settled(before, written, walk.tolerance):
                break

    def of(kind: str) -> Column:
        mass = F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
        return F.format_string("%.11e", mass).cast("double").alias(kind)  # twelve digits, so that the order of sums doesn't show

    return ranks.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, stages: Stages, rules: Sequence[UrlRule] = RULES, walk: Walk = Walk()) -> DataFrame:
    """``pages`` with ``RESULTS``, and without ``html``; a column named like one of the results is replaced."""
    ruled = with_rule(pages.drop(*RESULTS), rules)
    links = stages.write(host_links(ruled), "links")
    ranks = stages.write(propagate(links, seeds(ruled), stages, walk), "hosts")
    ruled = ruled.drop("html") if "html" in pages.columns else ruled
    both = ruled.join(ranks.withColumnRenamed("host", "__host"), F.col("host") == F.col("__host"), "left").drop("__host")
    both = both.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    spread = F.when(F.col("distrust") > F.col("trust") * walk.ratio, "block").otherwise("allow")
    return both.withColumn("verdict", F.coalesce("__rule_verdict", spread)).drop("__rule_verdict")
