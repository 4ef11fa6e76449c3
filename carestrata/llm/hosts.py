"""URL filters by link-graph propagation.

A page is judged by the longest rule that fits its URL. For all other pages the host decides: trust spreads from the
hosts of allowed pages along host edges (personalised PageRank), distrust spreads from the hosts of blocked pages
against them (a host that links to bad hosts is suspect), and a host is blocked if its distrust outweighs its trust.

Edges: a host links to the hosts that its pages' href and src attributes name, weighted by the number of such links,
and a host and the domain directly above it are linked both ways with weight one if both have pages. A link to the own
host is no edge. Seeds weigh as many pages as the rules decide, over all decided pages, so both scores share a unit.
All hosts are scored in one join and one grouping a round, on edges summed beforehand. A round deals out no more than
`DAMPING` of what the one before it did, so after `rounds_for(BOUND)` of them the changes of all scores together stay
below `BOUND` on any graph, however long its paths; every few rounds are written to the shared folder. A host with a
great share of the pages is one row of every such table.

A URL is read as its rule says: host after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; path up to
"?", "#" or the end. A null URL or one without "://" has neither, fits no rule and is allowed. A null html has no
links, and a very long one any number. Repeated rows count as often as they occur, null ids are kept. A host that no score reaches is
allowed, and so is one whose scores are equal. An empty table gives no rows. Only page_id, url and html are read, so other
columns may have any names.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
DAMPING, BOUND, DIGITS = 0.85, 1e-4, 9
WRITE_EVERY = 8


def rounds_for(bound: float, damping: float = DAMPING) -> int:
    """Rounds after which less than `bound` of all score is still to be dealt out."""
    return math.ceil(math.log(bound) / math.log(damping))


ROUNDS = rounds_for(BOUND)


@dataclass(frozen=True)
class UrlRule:
    """`domain` stands for itself and all subdomains; `path` is how a URL's path must start."""

    domain: str
    path: str
    verdict: str


RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)


def lowered(host: Column) -> Column:
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def by_rule(rules: Sequence[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule, verdict = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for r in sorted(rules, key=lambda r: (-len(r.domain + r.path), r.domain, r.path)):
        fits = ((host == r.domain) | F.endswith(host, F.lit("." + r.domain))) & F.startswith(path, F.lit(r.path))
        rule, verdict = rule.when(fits, F.lit(r.domain + r.path)), verdict.when(fits, F.lit(r.verdict))
    return rule, verdict


def ruled(pages: DataFrame, rules: Sequence[UrlRule], *others: str) -> DataFrame:
    """`others` and host, path, rule, verdict."""
    url = F.coalesce("url", F.lit(""))
    parted = pages.select(*others, lowered(F.regexp_extract(url, URL, 1)).alias("host"), F.regexp_extract(url, URL, 2).alias("path"))
    rule, verdict = by_rule(rules, F.col("host"), F.col("path"))
    return parted.select(*others, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight); `hosts` has the hosts of pages."""
    url = F.coalesce("url", F.lit(""))
    links = pages.select(
        lowered(F.regexp_extract(url, URL, 1)).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst")
    ).select("src", lowered(F.col("dst")).alias("dst"))
    links = links.where((F.col("src") != F.col("dst")) & (F.col("src") != "")).groupBy("src", "dst").agg(F.count("*").alias("weight"))
    above = hosts.select(F.col("host").alias("sub"), F.regexp_extract("host", r"^[^.]*\.(.+)$", 1).alias("host"))
    above = above.where(F.col("host") != "").join(hosts.select("host"), "host")
    ways = F.explode(F.array(F.struct(F.col("sub").alias("src"), F.col("host").alias("dst")), F.struct(F.col("host").alias("src"), F.col("sub").alias("dst"))))
    domains = above.select(ways.alias("e")).select("e.src", "e.dst", F.lit(1).cast("long").alias("weight"))
    return links.unionByName(domains).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float) -> DataFrame:
    """(kind, host, score) after so many rounds from `seeds` (kind, host, seed): each round damps what came along edges.

    `edges` (kind, src, dst, share): what part of src's score dst gets. Score that has no edge to leave by is lost.
    """
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    base = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"))
    for done in range(1, rounds + 1):
        came = edges.join(scores.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score")
        )
        scores = base.union(came).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if done % WRITE_EVERY == 0 or done == rounds:
            scores = kept(scores, "host-scores")
    return scores


def host_scores(pages: DataFrame, rules: Sequence[UrlRule] = RULES, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) of every host that a score reaches."""
    judged = ruled(pages, rules).where(F.col("host") != "")
    hosts = judged.groupBy("host").agg(F.count_if(F.col("verdict") == "allow").alias("trust"), F.count_if(F.col("verdict") == "block").alias("distrust"))
    hosts = kept(hosts, "host-pages")
    whole = hosts.agg(F.sum(F.col("trust") + F.col("distrust")).alias("n")).first()["n"] or 1
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("trust", "distrust")]))
    seeds = hosts.select("host", kinds.alias("k")).where("k.n > 0")
    seeds = kept(seeds.select("k.kind", "host", (F.col("k.n") / float(whole)).alias("seed")), "host-seeds")

    edges = kept(host_edges(pages, hosts), "host-edges")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    leaving = kept(both.groupBy("kind", "src").agg(F.sum("weight").alias("all")), "host-leaving")
    shares = both.join(leaving, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share"))
    scores = spread(kept(shares, "host-shares"), seeds, rounds, damping)
    return scores.groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust: a host is blocked if distrust is over `threshold` of both."""
    scores = kept(host_scores(pages, rules), "host-verdicts").withColumnRenamed("host", "scored")
    rows = ruled(pages, rules, "page_id").join(scores, F.col("host") == F.col("scored"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    blocked = F.round(distrust - threshold * (trust + distrust), DIGITS) > 0
    verdict = F.coalesce("verdict", F.when(blocked, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))


def _case_sql(what: str) -> str:
    rules = sorted(RULES, key=lambda r: (-len(r.domain + r.path), r.domain, r.path))
    return "CASE " + " ".join(
        f"WHEN (host = '{r.domain}' OR ends_with(host, '.{r.domain}')) AND starts_with(path, '{r.path}')"
        f" THEN '{r.domain + r.path if what == 'rule' else r.verdict}'"
        for r in rules
    ) + " END"


_A_TO_Z = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
_LINK_SQL = LINK.replace("'", "''")
OP4_SQL = f"""
WITH RECURSIVE parted AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), {_A_TO_Z}) AS host,
         regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
judged AS (SELECT *, {_case_sql("rule")} AS rule, {_case_sql("verdict")} AS said FROM parted),
hosts AS (
  SELECT host, count(*) FILTER (WHERE said = 'allow') AS trust, count(*) FILTER (WHERE said = 'block') AS distrust
  FROM judged WHERE host <> '' GROUP BY host),
kinds AS (SELECT 'trust' AS kind, host, trust AS n FROM hosts UNION ALL SELECT 'distrust', host, distrust FROM hosts),
seeds AS (SELECT kind, host, n / (SELECT sum(n) FROM kinds) AS seed FROM kinds WHERE n > 0),
links AS (
  SELECT host AS src, translate(unnest(regexp_extract_all(html, '{_LINK_SQL}', 1)), {_A_TO_Z}) AS dst FROM parted WHERE host <> ''),
domains AS (
  SELECT a.host AS sub, b.host AS dom FROM hosts a JOIN hosts b ON regexp_extract(a.host, '^[^.]*\\.(.+)$', 1) = b.host),
edges AS (
  SELECT src, dst, sum(weight) AS weight FROM (
    SELECT src, dst, 1 AS weight FROM links WHERE src <> dst
    UNION ALL SELECT sub, dom, 1 FROM domains UNION ALL SELECT dom, sub, 1 FROM domains)
  GROUP BY src, dst),
ways AS (SELECT 'trust' AS kind, src, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
shares AS (SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) AS share FROM ways),
rounds AS (
  SELECT 0 AS n, kind, host, seed AS score FROM seeds
  UNION ALL
  SELECT n, kind, host, sum(score) FROM (
    SELECT r.n + 1 AS n, seeds.kind, seeds.host, seed * (1 - {DAMPING}) AS score
    FROM seeds JOIN (SELECT DISTINCT n FROM rounds) r ON r.n < {ROUNDS}
    UNION ALL
    SELECT rounds.n + 1, rounds.kind, dst, score * share * {DAMPING}
    FROM rounds JOIN shares ON shares.kind = rounds.kind AND src = host WHERE rounds.n < {ROUNDS})
  GROUP BY ALL),
scores AS (
  SELECT host, coalesce(sum(score) FILTER (WHERE kind = 'trust'), 0) AS trust,
         coalesce(sum(score) FILTER (WHERE kind = 'distrust'), 0) AS distrust
  FROM rounds WHERE n = {ROUNDS} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(said, CASE WHEN round(coalesce(distrust, 0) - 0.5 * (coalesce(trust, 0) + coalesce(distrust, 0)), {DIGITS}) > 0
                           THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(trust, 0), 6)::DOUBLE AS trust, round(coalesce(distrust, 0), 6)::DOUBLE AS distrust
FROM judged j LEFT JOIN scores s ON j.host = s.host
"""
