"""URL filters: rules first, then link-graph propagation over hosts (DataFrame operations only).

Rules are ``host/path`` prefixes with an allow or block verdict; a rule fits its host
and all subdomains if the url's path starts with the rule's path, and the longest wins.
Where no rule fits, the host's propagated scores decide: personalised PageRank of
trust from hosts whose urls the rules allow, and of distrust over the reversed edges
from hosts whose urls the rules block.  Edges between hosts are the absolute links of
the pages (weighted by count) and, both ways, the step from a host to its parent
domain where both occur (weight 1), so that subdomains share a reputation.  Steps go on
until no score changes by ``TOLERANCE``, the last digit that scores are compared in.  A
host is blocked if its distrust is above ``ratio`` times its trust.

Scale: seeds and edges are counted with map-side combining, so a hot host costs one row
per task; each step joins the host table with the edge table, and the scores are written
every ``ROUND_STEPS`` steps; the damping ends it after about 180 steps on any graph and at
any size, sooner the more hosts share the seed.  Only hosts to be blocked
are joined back to the pages (broadcast if counted small, else a skew-split join).

Defined cases: a null url or one without ``://`` has an empty host and path, fits no
rule and is allowed unless the empty host is blocked (it never is: it has no edges);
null html has no links; repeated pages each keep a row; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
DAMPING = 0.85
#: Propagation has converged when no score changes by so much over ``ROUND_STEPS`` steps.
TOLERANCE = 1e-12
ROUND_STEPS = 16
#: Steps of the SQL form: what damping leaves of a score's change after them is below the tolerance.
SQL_STEPS = 176
RATIO = 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "^[\\s\\S]*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^[\\s\\S]*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Index of the longest rule that fits, or null.  The rule list is a parameter, not data."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), i))
    fits = [((host == rules[i].host) | host.endswith("." + rules[i].host)) & path.startswith(rules[i].path) for i in order]
    return F.coalesce(*[F.when(f, F.lit(i)) for f, i in zip(fits, order)], F.lit(None).cast("int"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(src, dst, w)`` over known hosts: counted absolute links and steps to the parent domain."""
    links = (pages.select("host", F.explode(F.regexp_extract_all(
        F.coalesce(F.col("html"), F.lit("")), F.lit("(?i)href\\s*=\\s*[\"']?((?:https?:)?//[^\"'\\s>]+)"), 1)).alias("href"))
        .select(F.col("host").alias("src"),
                url_host(F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), F.col("href")))
                         .otherwise(F.col("href"))).alias("dst"))
        .filter((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != ""))
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))
    child = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", "^[^.]+\\.(.+\\..+)$", 1).alias("dst"))
    child = child.filter(F.col("dst") != "").join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi")
    both = child.select("src", "dst").union(child.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.union(both.withColumn("w", F.lit(1.0))).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING) -> DataFrame:
    """Trust along the edges and distrust against them, converged: ``(host, trust, distrust)``.

    ``seeds``: ``(host, kind, seed)`` with kinds ``trust`` and ``distrust``, each summing to 1.
    """
    along = edges.select(F.lit("trust").alias("kind"), "src", "dst", "w").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("w")))
    out = along.groupBy("kind", "src").agg(F.sum("w").alias("out_w"))
    along = materialise(along.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("w") / F.col("out_w")).alias("p")), "url-edges")
    side, seeds = broadcast_if_small(along), materialise(seeds, "url-seeds")

    def walk(rank: DataFrame) -> DataFrame:
        for _ in range(ROUND_STEPS):
            moved = (rank.withColumnRenamed("host", "src").join(side, ["kind", "src"])
                     .select("kind", F.col("dst").alias("host"), (F.col("r") * F.col("p") * damping).alias("r")))
            start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("r"))
            rank = moved.union(start).groupBy("kind", "host").agg(F.sum("r").alias("r"))
        return rank

    rank, change = seeds.select("kind", "host", F.col("seed").alias("r")), 1.0
    while change >= TOLERANCE:
        last, rank = rank, materialise(walk(rank), "url-rank")
        moves = rank.union(last.select("kind", "host", -F.col("r"))).groupBy("kind", "host").agg(F.abs(F.sum("r")).alias("c"))
        change = moves.agg(F.max("c")).first()[0] or 0.0  # one number
    return rank.groupBy("host").agg(
        F.round(F.sum(F.when(F.col("kind") == "trust", F.col("r")).otherwise(0.0)), 12).alias("trust"),
        F.round(F.sum(F.when(F.col("kind") == "distrust", F.col("r")).otherwise(0.0)), 12).alias("distrust"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules: tuple[Rule, ...] = RULES, ratio: float = RATIO) -> DataFrame:
    """One row per page: id, host, path, rule, verdict."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    src = src.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    ruled = src.select("id", "host", "path", matching_rule(F.col("host"), F.col("path"), rules).alias("rule_no"))
    verdicts = F.array(*[F.lit(r.verdict) for r in rules])
    texts = F.array(*[F.lit(r.text) for r in rules])
    ruled = ruled.withColumn("rule", F.get(texts, F.col("rule_no"))).withColumn("by_rule", F.get(verdicts, F.col("rule_no")))
    ruled = materialise(ruled.drop("rule_no"), "url-ruled")
    per_host = materialise(ruled.filter(F.col("host") != "").groupBy("host").agg(
        F.count(F.when(F.col("by_rule") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked")), "url-hosts")
    total = per_host.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    seeds = per_host.select("host", F.lit("trust").alias("kind"), (F.col("allowed") / F.lit(float(total.a or 1))).alias("seed")).union(
        per_host.select("host", F.lit("distrust"), F.col("blocked") / F.lit(float(total.b or 1)))).filter(F.col("seed") > 0)
    scores = propagate(seeds, host_edges(src, per_host.select("host")))
    bad = materialise(scores.filter(F.col("distrust") > ratio * F.col("trust")).select("host", F.lit("block").alias("by_host")),
                      "url-bad")
    return (ruled.join(broadcast_if_small(bad), "host", "left")
            .select("id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict")))


def oracle_sql(steps: int = SQL_STEPS, damping: float = DAMPING, ratio: float = RATIO) -> str:
    """The same judgement in DuckDB SQL.

    A score is the sum over all steps of the seed's share (1 - damping) that has moved so far.
    """
    order = sorted(range(len(RULES)), key=lambda i: (-len(RULES[i].text), i))

    def pick(field: str) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{RULES[i].host}' OR host LIKE '%.{RULES[i].host}') AND starts_with(path, '{RULES[i].path}') THEN '{getattr(RULES[i], field)}'"
            for i in order) + " END"
    host = "regexp_extract(coalesce(%s, ''), '^(?s:.*?)://([^/?#]*)', 1)"
    lower = f"translate({host}, '{UPPER}', '{LOWER}')"
    return f"""WITH RECURSIVE p AS (SELECT page_id, html, {lower % 'url'} AS host,
      regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    ruled AS (SELECT page_id, host, path, {pick('text')} AS rule, {pick('verdict')} AS by_rule FROM p),
    hosts AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS a, count(*) FILTER (by_rule = 'block') AS b
      FROM ruled WHERE host <> '' GROUP BY host),
    seeds AS (SELECT host, 'trust' AS kind, a / (SELECT CAST(sum(a) AS DOUBLE) FROM hosts) AS seed FROM hosts WHERE a > 0
      UNION ALL SELECT host, 'distrust', b / (SELECT CAST(sum(b) AS DOUBLE) FROM hosts) FROM hosts WHERE b > 0),
    hrefs AS (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\\s*=\\s*["'']?((?:https?:)?//[^"''\\s>]+)', 1)) AS href FROM p),
    linked AS (SELECT host AS src, {lower % "CASE WHEN starts_with(href, '//') THEN 'http:' || href ELSE href END"} AS dst FROM hrefs),
    parents AS (SELECT host AS src, regexp_extract(host, '^[^.]+\\.(.+\\..+)$', 1) AS dst FROM hosts),
    child AS (SELECT src, dst FROM parents WHERE dst <> '' AND dst IN (SELECT host FROM hosts)),
    edges AS (SELECT src, dst, sum(w) AS w FROM (
      SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM linked WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst
      UNION ALL SELECT src, dst, 1.0::DOUBLE FROM child UNION ALL SELECT dst, src, 1.0::DOUBLE FROM child) GROUP BY src, dst),
    both_ways AS (SELECT 'trust' AS kind, src, dst, w FROM edges UNION ALL SELECT 'distrust', dst, src, w FROM edges),
    along AS (SELECT kind, src, dst, w / sum(w) OVER (PARTITION BY kind, src) AS p FROM both_ways),
    moved AS (SELECT 0 AS step, kind, host, seed AS r FROM seeds
      UNION ALL SELECT step + 1, a.kind, a.dst, sum(x.r * a.p * {damping}::DOUBLE) FROM moved x JOIN along a ON x.host = a.src AND x.kind = a.kind
      WHERE step < {steps} GROUP BY step, a.kind, a.dst),
    r AS (SELECT kind, host, sum(CASE WHEN step = {steps} THEN r ELSE r * (1 - {damping}::DOUBLE) END) AS r FROM moved GROUP BY kind, host),
    scores AS (SELECT host, round(sum(CASE WHEN kind = 'trust' THEN r ELSE 0 END), 12) AS trust,
      round(sum(CASE WHEN kind = 'distrust' THEN r ELSE 0 END), 12) AS distrust FROM r GROUP BY host)
    SELECT page_id, ruled.host, path, rule,
      coalesce(by_rule, CASE WHEN distrust > {ratio} * trust THEN 'block' END, 'allow') AS verdict
    FROM ruled LEFT JOIN scores ON ruled.host = scores.host"""
