"""HTML extraction: main text by what a host's pages repeat, found with suffix arrays.

A page's markup is read into blocks: the text between two block-level tags, in page order, with the part of the page it
lies in. The pages of a host are one stream of tokens (words, and the kind of block they stand in); its suffixes are
sorted by their first `RUN` tokens. Neighbours in that order that begin alike are a substring of `RUN` or more tokens
that stands in several places; if these are on enough distinct pages, all of it, overlapping ones joined, is boilerplate,
and blocks that it covers go. What is left are unique runs.

Markup is heeded besides. Parts that say what they are (navigation, forms, asides, adverts, notices, reader comments and
so on, by element, role, class or id) never count as text, on a host with one page as well. If a page marks its main
part (`article`, `main`), blocks outside go, and blocks in it stay though other pages repeat them: copies of an article,
or passages that many articles quote, are no boilerplate.

Boilerplate is what stands on at least two pages and a `SHARE` of those of its host. Hosts are dealt into shards by a hash
of the page, of at most about `SHARD_PAGES` pages and `SHARD_CHARS` characters, so that a host with a third of all pages
is many tasks, and the shards change nothing about the result: what stands on a share of the host's pages stands on that
share of some shard's, so each shard's suffix array names such runs, all shards count the runs that any of them named, and
the sums say which are boilerplate. Between shards a run is the 64-bit hash of its tokens.

Cases: null or empty html has no blocks and gives an empty text; pages without a host are one host; a repeated page is a
page of its own; a page of any length is one row and is never cut; an empty table gives no rows; other columns are kept,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from hashlib import blake2b
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from carestrata.llm.arrays import SPACE, WORD, chunks, flat, grams, tokens
from carestrata.llm.store import kept, table

RUN, SHARE = 8, 0.02
#: Words are what stands between spaces.
BY_SPACE = np.where(np.arange(256) == 32, SPACE, WORD).astype(np.uint8)
SHARD_PAGES, SHARD_CHARS = 256, 8 << 20

#: Elements whose content is no text of a page.
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "textarea", "select", "datalist"}
#: Parts of a page that aren't its main text.
ASIDE = {"nav", "aside", "form", "footer", "menu", "dialog", "button", "fieldset"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements with one of these names among the words of class, id or role are no main text.
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "masthead", "menu", "menubar", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo", "promoted",
    "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
MAIN_ROLES = {"main", "article"}

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"""
    r"""|<(?P<raw>script|style|textarea|title|noscript|iframe)\b(?:[^<>"']|"[^"<]*+"|'[^'<]*+')*+>.*?(?:</(?P=raw)\s*+>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/><]*+)(?P<rest>(?:[^<>"']|"[^"<]*+"|'[^'<]*+'|"[^"]{0,2048}"|'[^']{0,2048}'|["'])*+)>""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WHITE = re.compile(r"\s+")
#: An open one of these ends where the next of its kind begins.
UNCLOSED = {"p", "li", "dt", "dd", "td", "th", "tr", "option"}
#: Of an article, only these names say that it isn't one.
NO_ARTICLE = {"comment", "comments", "reply", "replies", "ad", "advert", "advertisement", "promo", "related", "sponsored", "teaser"}


class Block(NamedTuple):
    text: str  # not empty, on one line
    kind: str  # of the innermost block-level tag opened
    level: int  # 2 in an article, 1 in another main part, else 0
    aside: bool  # in a part that says it is no main text


def named(rest: str, whole: bool = False) -> tuple[set[str], bool]:
    """The words (or whole names) of class, id and role of a tag, and whether it isn't shown."""
    words: set[str] = set()
    unseen = False
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            words |= {w.lower() for w in (value.split() if whole else NAME_WORD.findall(value))}
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            unseen = True
    return words, unseen


class Reader:
    """Goes through the tags of one page and gathers its blocks."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.kind = ""
        self.main: list[str] = []  # open elements of the main part
        # the element left open that hides text or sets it aside, and how deep its own kind is nested in it
        self.part, self.depth, self.hides = "", 0, False

    def text(self, piece: str) -> None:
        if not (self.part and self.hides):
            self.pieces.append(unescape(piece) if "&" in piece else piece)

    def close_block(self) -> None:
        text = WHITE.sub(" ", "".join(self.pieces)).strip()
        if text:
            level = (2 if "article" in self.main else 1) if self.main else 0
            self.blocks.append(Block(text, self.kind, level, bool(self.part)))
        self.pieces = []

    def leave_part(self) -> None:
        self.close_block()
        self.part, self.depth = "", 0

    def begin(self, name: str, rest: str) -> None:
        article = name in ("article", "main")
        words, unseen = named(rest, article) if rest and not rest.isspace() else (set(), False)
        main = article or name in ("div", "section") and not words.isdisjoint(MAIN_ROLES)
        if article:
            out = not words.isdisjoint(NO_ARTICLE)
        else:
            out = name in ASIDE or not words.isdisjoint(NAMES) or name == "header" and not self.main
        hides = name in HIDDEN or unseen
        if self.part in UNCLOSED and (name == self.part or self.part == "p" and name in BLOCKS):
            self.leave_part()
        if self.part and main and not out and not self.main:
            self.leave_part()  # an element left open before the main part doesn't hide it
        if name == "br":
            self.text(" ")
        elif name in BLOCKS:
            self.close_block()
            self.kind = name
        if name in VOID or rest.endswith("/") and name not in BLOCKS:
            return
        if self.part:
            self.depth += name == self.part
        elif (out or hides) and name not in ("body", "html"):
            self.close_block()
            self.part, self.depth, self.hides = name, 1, hides
        elif main or self.main and name == self.main[-1]:
            self.main.append(name)

    def end(self, name: str) -> None:
        if self.part and name in ("article", "main") and name in self.main and name != self.part:
            self.leave_part()  # nor does one left open inside go beyond its end
        if self.part:
            self.depth -= name == self.part
            if not self.depth:
                self.leave_part()
            elif name in BLOCKS:
                self.close_block()
            return
        if name in BLOCKS:
            self.close_block()
            self.kind = ""
        if name in self.main:
            del self.main[len(self.main) - 1 - self.main[::-1].index(name) :]

    def read(self, html: str) -> list[Block]:
        at = 0
        for tag in TAG.finditer(html):
            if tag.start() > at:
                self.text(html[at : tag.start()])
            at = tag.end()
            if name := tag["name"]:
                if tag["end"]:
                    self.end(name.lower())
                else:
                    self.begin(name.lower(), tag["rest"])
        self.text(html[at:])
        self.close_block()
        return self.blocks


def blocks_of(html: str | None) -> list[Block]:
    return Reader().read(html or "")


def hashed_tokens(pages: Sequence[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens of some pages in order, with their page and block (counted over all pages).

    A block's kind is a token before its words. A token of block -1 ends each page.
    """
    every = [b for blocks in pages for b in blocks]
    raw, at = flat(pa.array([b.text for b in every], pa.string()))
    words, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, places in chunks(raw, at):
        found = tokens(data, places, BY_SPACE)
        words.append(found.hash)
        sizes.append(np.diff(found.first))
    word, size = np.concatenate(words), np.concatenate(sizes)
    kinds = {k: int.from_bytes(blake2b(k.encode(), digest_size=8).digest()) for k in {b.kind for b in every}}
    kind = np.array([kinds[b.kind] for b in every], np.uint64)
    per_page = np.array([len(blocks) for blocks in pages], np.int64)
    ends = np.concatenate([[0], np.cumsum(size + 1)])[np.cumsum(per_page)]
    all_tokens = np.insert(np.insert(word, np.cumsum(size) - size, kind), ends, np.uint64(0))
    block = np.insert(np.repeat(np.arange(len(every)), size + 1), ends, -1)
    page = np.repeat(np.arange(len(pages)), np.diff(ends, prepend=0) + 1)
    return all_tokens, page, block


def numbered(hashed: np.ndarray, page: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Tokens as numbers. A number of its own ends each page, so that nothing goes on over it."""
    return np.where(block < 0, -1 - page, ranks(hashed))


def ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def suffix_order(tokens: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first `run` tokens, and the rank of each suffix; by doubling. Equal begins rank alike."""
    n = len(tokens)
    rank, width = ranks(tokens), 1
    while width < run:
        step = min(width, run - width)  # the last step only goes as far as `run`
        behind = np.full(n, -1, np.int64)
        behind[: n - step] = rank[step:]
        rank = ranks(rank * (n + 1) + behind + 1)
        width += step
    return np.argsort(rank, kind="stable"), rank


def repeated_begins(tokens: np.ndarray, page: np.ndarray, run: int, least: float) -> np.ndarray:
    """Where `run` tokens begin that stand on at least `least` distinct pages."""
    if len(tokens) < run:
        return np.zeros(0, np.int64)
    order, rank = suffix_order(tokens, run)
    groups, pages = rank[order], page[order]
    # order is stable, so a group's places are in page order: count where the page changes
    fresh = np.ones(len(order), bool)
    fresh[1:] = (groups[1:] != groups[:-1]) | (pages[1:] != pages[:-1])
    return order[np.bincount(groups, weights=fresh)[groups] >= least]


def covered_tokens(begins: np.ndarray, n: int, run: int) -> np.ndarray:
    """Which of `n` tokens lie in the `run` tokens from one of these places on."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, np.minimum(begins + run, n), -1)
    return np.cumsum(edges[:-1]) > 0


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, run: int, least: int) -> np.ndarray:
    """Which tokens lie in a substring of `run` or more tokens that stands on at least `least` distinct pages."""
    return covered_tokens(repeated_begins(tokens, page, run, least), len(tokens), run)


def run_hashes(hashed: np.ndarray, block: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `run` tokens within one page, the same in every shard, and their places, from `hashed_tokens`."""
    ends = np.flatnonzero(block < 0)
    return grams(hashed, np.concatenate([[0], np.stack([ends, ends + 1], 1).ravel()]), run)


def least_pages(pages: int, share: float) -> int:
    return max(2, int(np.ceil(share * pages)))


def unnamed(pages: Column, share: float) -> Column:
    """On how many pages of a shard of so many pages a run may stand without being named there."""
    return F.greatest(F.lit(0), F.ceil(F.lit(share) * pages - F.lit(1e-6)) - 1)


def named_runs(pages: Sequence[list[Block]], run: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The runs that stand on a share of a shard's pages: their hashes, and on how many pages above `unnamed` each stands.

    A run with that share of its host is named by a shard.
    """
    hashed, page, block = hashed_tokens(pages)
    least = max(1, int(np.ceil(share * len(pages) - 1e-6)))
    begins = repeated_begins(numbered(hashed, page, block), page, run, least)
    value, place = run_hashes(hashed, block, run)
    hit = np.isin(place, begins)
    found, n = page_counts(value[hit], page[place[hit]])
    return found, n - (least - 1)


def pages_with(pages: Sequence[list[Block]], run: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the wanted runs that some pages have: their hashes, and on how many of the pages each stands."""
    hashed, page, block = hashed_tokens(pages)
    value, place = run_hashes(hashed, block, run)
    hit = np.isin(value, wanted)
    return page_counts(value[hit], page[place[hit]])


def page_counts(value: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, and on how many distinct pages each stands."""
    order = np.lexsort((page, value))
    value, page = value[order], page[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (page[1:] != page[:-1])
    return np.unique(value[fresh], return_counts=True)


def main_texts(pages: Sequence[list[Block]], run: int = RUN, share: float = SHARE, runs: np.ndarray | None = None) -> list[tuple[str, int]]:
    """Of each of some pages of one host: its main text, and the number of its blocks that repeated runs cover.

    These are the runs of given hashes, or else what the pages repeat among themselves.
    """
    hashed, page, block = hashed_tokens(pages)
    if runs is None:
        covered = repeated_tokens(numbered(hashed, page, block), page, run, least_pages(len(pages), share))
    else:
        value, place = run_hashes(hashed, block, run)
        covered = covered_tokens(place[np.isin(value, runs)], len(hashed), run)
    n = int(block.max(initial=-1)) + 1
    repeated = np.bincount(block[(block >= 0) & ~covered], minlength=n) == 0
    out, at = [], 0
    for blocks in pages:
        gone = repeated[at : at + len(blocks)].tolist()
        # what a page marks as its main part is neither joined by other blocks nor boilerplate where it is repeated
        level = max((b.level for b in blocks), default=0)
        keeps = [not b.aside and (b.level == level if level else not g) for b, g in zip(blocks, gone)]
        out.append(("\n\n".join(b.text for b, k in zip(blocks, keeps) if k), sum(gone)))
        at += len(blocks)
    return out


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def sharded(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(row, blocks, host, shard, shards, least, above): `row` has all columns but html; shards of a host are of about equal
    size, by a hash. `least` is on how many of the host's pages boilerplate stands; if less than `above` pages come together
    above what shards leave unnamed, a run can't reach it. Both are null for hosts of one shard."""
    rows = pages.select(
        F.struct(*[c for c in pages.columns if c != "html"]).alias("row"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        host_of("url").alias("host"),
    )
    sizes = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("chars"))
    shards = F.ceil(F.greatest(F.col("n") / SHARD_PAGES, F.col("chars") / SHARD_CHARS)).cast("long")
    # only hosts of several shards: few rows, whose size Spark sees in the written table
    several = kept(sizes.select("host", shards.alias("shards"), F.col("n").alias("on_host")).where("shards > 1"), "large-hosts")
    shard = F.pmod(F.xxhash64("row.page_id", "row.url", "html"), F.coalesce("shards", F.lit(1))).alias("shard")
    dealt = rows.join(several, "host").select("host", shard).groupBy("host", "shard").agg(unnamed(F.count("*"), share).alias("unnamed"))
    least = F.greatest(F.lit(2), F.ceil(F.lit(share) * F.col("on_host")))
    large = several.join(dealt.groupBy("host").agg(F.sum("unnamed").alias("unnamed")), "host")
    large = kept(large.select("host", "shards", least.alias("least"), (least - F.col("unnamed")).alias("above")), "large-hosts")
    return rows.join(large, "host", "left").select(
        "row", lines_of("html").alias("blocks"), "host", shard, F.coalesce("shards", F.lit(1)).alias("shards"), "least", "above"
    )


def lines_of(html: str) -> Column:
    """The blocks of a page, a line for each: level, whether aside, kind and text."""

    @F.arrow_udf("string")
    def lines(pages: pa.Array) -> pa.Array:
        return pa.array(["\n".join(map(line_of, blocks_of(h))) for h in pages.to_pylist()], pa.string())

    return lines(html)


def line_of(block: Block) -> str:
    return f"{block.level}{block.aside:d}{block.kind} {block.text}"


def block_in(line: str) -> Block:
    marks, text = line.split(" ", 1)
    return Block(text, marks[2:], int(marks[0]), marks[1] == "1")


def blocks_in(rows: pa.Table) -> list[list[Block]]:
    return [[block_in(line) for line in lines.split("\n") if line] for lines in rows.column("blocks").to_pylist()]


FOUND = {"host": pa.string(), "shards": pa.int64(), "least": pa.int64(), "above": pa.int64(), "run": pa.int64(), "n": pa.int64()}
FOUND_DDL = "host string, shards long, least long, above long, run long, n long"


def found_in(rows: pa.Table, value: np.ndarray, n: np.ndarray) -> pa.Table:
    """Runs of the host of `rows`, which has no rows only if there are no runs."""
    of = [pa.repeat(rows.column(c)[0], len(n)) if len(n) else pa.array([], t) for c, t in [*FOUND.items()][:4]]
    return pa.table([*of, pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], [*FOUND])


def of_hosts(found: DataFrame) -> DataFrame:
    return found.groupBy("host", "shards", "least", "above", "run").agg(F.sum("n").alias("n"))


def candidates(shards: DataFrame, run: int, share: float) -> DataFrame:
    """(host, shards, least, above, run): hashes of the runs that may stand on a share of the host's pages.

    Where pages are so long that a shard has few, it names what stands on one, so only runs that can reach `least` are left.
    """

    def name(rows: pa.Table) -> pa.Table:
        return found_in(rows, *named_runs(blocks_in(rows), run, share))

    return of_hosts(shards.groupBy("host", "shard").applyInArrow(name, FOUND_DDL)).where("n >= above").drop("n")


def host_runs(shards: DataFrame, run: int, share: float) -> DataFrame:
    """(host, shard, run): for each shard of each host the hashes of the runs that stand on a share of the host's pages."""

    def count(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        return found_in(wanted, *pages_with(blocks_in(rows), run, wanted.column("run").to_numpy().view(np.uint64)))

    to_all = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard")
    asked = candidates(shards, run, share).select("*", to_all).groupBy("host", "shard")
    counted = shards.groupBy("host", "shard").cogroup(asked).applyInArrow(count, FOUND_DDL)
    return of_hosts(counted).where("n >= least").select("host", to_all, "run")


def extracted(pages: DataFrame, run: int = RUN, share: float = SHARE) -> DataFrame:
    """`pages` (page_id, url, html and others) without html, with `text`, its `n_chars`, and `n_repeated`, the number of
    blocks that the host repeats. Existing columns of these names are replaced.

    Shards are named, counted and extracted in one plan by the same grouping of the same columns, so that their blocks are
    exchanged once: Spark reads that exchange again for each of the three.
    """
    shards = sharded(pages, share)
    form = StructType([*shards.schema["row"].dataType.fields])
    others = [f.name for f in form.fields if f.name not in ("text", "n_chars", "n_repeated")]

    def made(rows: pa.Table, found: list[tuple[str, int]]) -> pa.Table:
        columns = [pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())]
        return pa.table([rows.column("row").combine_chunks(), *columns], ["row", "text", "n_repeated"])

    def alone(rows: pa.Table) -> pa.Table:
        return made(rows, main_texts(blocks_in(rows), run, share))

    def among(rows: pa.Table, runs: pa.Table) -> pa.Table:
        return made(rows, main_texts(blocks_in(rows), run, share, runs.column("run").to_numpy().view(np.uint64)))

    out = StructType([StructField("row", form), StructField("text", StringType()), StructField("n_repeated", LongType())])
    done = shards.where("shards = 1").groupBy("host", "shard").applyInArrow(alone, out)
    several = shards.where("shards > 1")
    runs = host_runs(several, run, share).groupBy("host", "shard")
    done = done.unionByName(several.groupBy("host", "shard").cogroup(runs).applyInArrow(among, out))
    return done.select(*[F.col("row")[c].alias(c) for c in others], "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


def op11_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
