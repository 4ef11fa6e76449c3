"""Links in fetched HTML pages and the choice of the release to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.functions.releases import (
    CODE_SET_FOLDER,
    CODE_SET_SITE,
    REGISTRY_FOLDER,
    REGISTRY_SITE,
    absolute_url,
    code_set_priority,
    last_segment,
    monthly_score,
    release_info,
    release_kind,
    weekly_score,
)

_ANCHOR = r"(?is)<a\b[^>]*\bhref\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)[^>]*>.*?</a\s*>"
_HREF = r"(?is)\A<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def _unescape(text: Column) -> Column:
    for entity, char in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """`key, ordinal, href, link_text` for every anchor with an href, in page order."""
    anchors = F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(0))
    rows = pages.select(key, F.posexplode(anchors).alias("ordinal", "anchor"))
    href = F.concat(*[F.regexp_extract("anchor", _HREF, i) for i in (1, 2, 3)])
    text = F.regexp_replace(F.col("anchor"), r"(?s)<[^>]*>", "")
    return rows.select(key, "ordinal", _unescape(href).alias("href"), F.trim(_unescape(text)).alias("link_text"))


def registry_releases(links: DataFrame) -> DataFrame:
    """Links to registry release archives with kind, rank score, absolute URL and parsed name."""
    name = last_segment(F.col("href"))
    kind = release_kind(F.col("href"))
    score = F.when(kind == "weekly", weekly_score(name)).otherwise(monthly_score(name))
    # an array of one release or none, so that a filter on its fields does not make them a second time
    found = F.array(F.struct(name.alias("name"), kind.alias("kind"), score.alias("score")))
    found = F.filter(found, lambda r: r["kind"].isNotNull() & r["score"].isNotNull())
    return links.select("*", F.explode(found).alias("_r")).select(
        *links.columns,
        "_r.*",
        absolute_url(F.col("href"), REGISTRY_SITE, REGISTRY_FOLDER).alias("url"),
        release_info(F.col("name")).alias("info"),
    )


def latest_releases(releases: DataFrame, by: str = "kind") -> DataFrame:
    """The release with the highest score per group (of equal scores the greatest name); no group is sorted."""
    top = F.max_by(F.struct("name", "url", "score"), F.struct("score", "name", "url"))
    return releases.groupBy(by).agg(top.alias("r")).select(by, "r.*")


def code_set_link(links: DataFrame, version: str, key: str = "page_id") -> DataFrame:
    """Per page the best code-set link: the wanted version, else the current one, else the first that looks right."""
    rank = code_set_priority(F.col("link_text"), F.col("href"), version)
    url = absolute_url(F.col("href"), CODE_SET_SITE, CODE_SET_FOLDER)
    found = links.withColumn("priority", rank).where(F.col("priority").isNotNull())
    best = F.min_by(
        F.struct(last_segment(F.col("href")).alias("name"), url.alias("url"), "priority"), F.struct("priority", "ordinal")
    )
    return found.groupBy(key).agg(best.alias("b")).select(key, "b.*")
