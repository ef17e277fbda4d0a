"""URL filters: host and path rules, and trust and distrust passed along the links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import packed, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Allow or block the urls of a host and its subdomains whose path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """From behind the first :// up to /, ?, # or the end, A to Z lower-cased; empty for null or no ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From behind the host up to ?, # or the end; empty for null or no ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The rule with the longest name that fits, as (length, name, verdict), or null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def host_edges(pages: DataFrame) -> DataFrame:
    """(`src`, `dst`, `weight`): links of a host's pages to other hosts, and between a host and its parent domain.

    Links are the anchors that name a host; `weight` is their number. A link within
    the host is no edge. A host and the domain one label up vouch for each other with weight 1 if both
    have pages, as only a domain's owner gives out names below it.
    """
    links = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(
            F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^\s"'>]+)"""), F.lit(1))
        ).alias("link"),
    )
    target = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link")))
    linked = links.select("src", target.alias("dst")).groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    family = hosts.select(F.col("host").alias("src"), parent.alias("dst")).join(
        hosts.select(F.col("host").alias("dst")), "dst", "left_semi"
    )
    both = family.select("src", "dst").union(family.select("dst", "src")).withColumn("weight", F.lit(1.0))
    return (
        linked.union(both)
        .where("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst")
        .agg(F.sum("weight").alias("weight"))
    )


def page_rank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-5, cut_every: int = 6) -> DataFrame:
    """(`host`, `score`): personalised PageRank from the seeds (`host`, `seed`) over the edges.

    A host passes `damping` of its score on by weight of its edges and gets (1 - damping) of its seed; what
    a host without edges would pass on is lost, so scores compare between runs but need not sum to one.
    Each round passes on what the one before brought, until that is together at most `tolerance` of the first:
    after 71 rounds at most, as each leaves `damping` of the last. Scores are summed within each task before the
    shuffle. Every `cut_every` rounds they are written, which cuts the lineage, and the sum of what is still to
    be passed on, one number, comes to the driver.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = written(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("part")))
    start = written(seeds.groupBy("host").agg(((1 - damping) * F.sum("seed")).alias("score")))

    def left_over(scores: DataFrame) -> float:
        return scores.agg(F.coalesce(F.sum("new"), F.lit(0.0))).first()[0]

    scores = start.withColumn("new", F.col("score"))
    first = left = left_over(scores)
    while left > tolerance * first:
        for _ in range(cut_every):
            passed = scores.join(shares, scores["host"] == shares["src"]).select(
                F.col("dst").alias("host"), (damping * F.col("new") * F.col("part")).alias("new")
            )
            both = passed.select("host", F.col("new").alias("score"), "new").union(scores.select("host", "score", F.lit(0.0)))
            scores = both.groupBy("host").agg(F.sum("score").alias("score"), F.sum("new").alias("new"))
        scores = written(scores)
        left = left_over(scores)
    return scores.select("host", "score")


def host_scores(pages: DataFrame, rules: tuple[Rule, ...] = RULES, **options) -> DataFrame:
    """(`host`, `trust`, `distrust`) of every host that a score reaches.

    Trust starts at hosts with pages that a rule allows and follows the links; distrust starts at hosts
    with pages that a rule blocks and goes against them, to those who link there. A seed is the number of
    such pages.
    """
    edges = written(host_edges(pages))
    host = host_of(F.col("url"))
    rule = matching_rule(host, path_of(F.col("url")), rules)
    ruled = pages.select(host.alias("host"), rule["verdict"].alias("verdict")).where("verdict is not null and host <> ''")
    seeds = written(ruled.groupBy("host", "verdict").agg(F.count("*").cast("double").alias("seed")))
    trust = page_rank(edges, seeds.where("verdict = 'allow'"), **options)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = page_rank(back, seeds.where("verdict = 'block'"), **options)
    return (
        trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust"))
        .union(distrust.select("host", F.lit(0.0), "score"))
        .groupBy("host")
        .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    )


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, most_distrust: float = 0.5, **options) -> DataFrame:
    """Every row as struct `row` with `host`, `path`, `rule`, `trust`, `distrust` and `verdict`.

    The longest fitting rule decides; else a host is blocked if distrust is more than `most_distrust` of
    trust and distrust together, and allowed if nothing is known of it. Null urls have an empty host and are
    allowed; null html has no links; repeated rows count as often as they occur.
    """
    scores = host_scores(pages, rules, **options).withColumnRenamed("host", "h")
    rows = packed(pages).withColumns({"host": host_of(F.col("row.url")), "path": path_of(F.col("row.url"))})
    rows = rows.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    bad = distrust > most_distrust * (trust + distrust)
    return rows.join(scores, F.col("host") == F.col("h"), "left").select(
        "row", "host", "path", F.col("fit.name").alias("rule"), trust.alias("trust"), distrust.alias("distrust"),
        F.coalesce("fit.verdict", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
