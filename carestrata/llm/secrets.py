"""Secret scans through a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query. The index holds, for every trigram that some query names,
the texts that contain it (postings on a hash of the text, so copies share one posting). A clause's postings are
intersected, its rule's candidates are the union over clauses, and only candidates are searched with the expression. A
rule without mandatory trigrams searches all texts. The index only leaves out texts that can't match; results are those
of searching everything.

Spans are leftmost non-overlapping matches of a rule, in code points, end exclusive; matches shorter than the rule asks
are dropped after matching. They're found by splitting a text at the matches and adding up lengths, so all is done by
built-in functions. Null and empty texts have no span. Rows are independent of each other and keep their order of
columns; repeated rows get the same spans, null ids are left as they are. An existing output column is replaced. A text
of any length, with any number of spans, is searched whole, in time in proportion. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table, text_or_empty
from carestrata.llm.trigrams import ALWAYS, trigram_query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of a group (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
)
RULES = BASE + MORE


def postings(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The index: (gram, key) for the trigrams that the rules' queries name; `texts` has `text` and its hash `key`."""
    grams = sorted({g for r in rules for clause in trigram_query(r.pattern) for g in clause})
    named = F.array(*[F.lit(g) for g in grams]) if grams else F.array().cast("array<string>")
    # an array of one text, so that the text is lowered once and not for each trigram
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(named, lambda g: F.contains(low, g)))
    return texts.select(F.explode(F.get(held, 0)).alias("gram"), "key").distinct()


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, rules): the numbers of the rules whose trigram query a text fulfils."""
    asked = [
        (i, c, gram, len(clause))
        for i, r in enumerate(rules)
        for c, clause in enumerate(trigram_query(r.pattern))
        for gram in sorted(clause)
    ]
    clauses = index.sparkSession.createDataFrame(asked, "rule int, clause int, gram string, needed int")
    full = index.join(F.broadcast(clauses), "gram").groupBy("key", "rule", "clause").agg(F.count("*").alias("n"), F.first("needed").alias("needed"))
    return full.where(F.col("n") == F.col("needed")).groupBy("key").agg(F.collect_set("rule").alias("rules"))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Array of {start, order, kind, end} of one rule in one text."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"),
        F.regexp_extract_all(text, pattern, 0).alias("match"),
        F.regexp_extract_all(text, pattern, rule.group).alias("value"),
    )
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")

    found = F.filter(found, lambda x: x["match"].isNotNull())

    def span(x: Column, at: Column) -> Column:
        start = at + F.length(x["before"])
        end = start + F.length(x["match"])
        kept = F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.when(F.length(x["value"]) >= rule.least, kept)

    # an array of one array, so that the matches are found once
    sizes = lambda xs: F.transform(xs, lambda x: F.length(x["before"]) + F.length(x["match"]))
    spans = F.transform(F.array(found), lambda xs: F.zip_with(xs, sums_before(sizes(xs)), span))
    return F.when(F.rlike(text, F.lit(least_form(rule))), F.filter(F.get(spans, 0), lambda s: s.isNotNull())).otherwise(none)


def sums_before(values: Column, block: int = 256) -> Column:
    """For each of an array's numbers the sum of those before it.

    Appending copies an array, so sums are made in blocks of `block` numbers, and over the blocks' totals: a text of very
    many spans takes time in proportion to their number.
    """
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))

    def running(xs: Column) -> Column:
        return F.aggregate(xs, empty, lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["sums"], s["at"]).alias("sums")))

    last = F.floor((F.size(values) - 1) / block).cast("int")
    blocks = F.when(F.size(values) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * block + 1, block)))
    parts = F.transform(F.array(F.transform(blocks, running)), lambda all: F.zip_with(
        all, running(F.transform(all, lambda p: p["at"]))["sums"], lambda p, at: F.transform(p["sums"], lambda v: v + at)
    ))
    return F.coalesce(F.flatten(F.get(parts, 0)), F.array().cast("array<int>"))


def least_form(rule: Rule) -> str:
    """A cheap expression that is found in every text with a span of the rule."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1:
        fixed = rule.pattern.index("[")
        return f"{rule.pattern[:-1]}{{{max(1, rule.least - fixed)},}}"
    return rule.pattern


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: str) -> Column:
    return F.filter("found", lambda s: s["kind"] == kind)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """`docs` with `found`: all spans of all rules as {start, order, kind, end}, by start and then by rule."""
    texts = docs.select(text_or_empty().alias("text")).select("text", F.xxhash64("text").alias("key"))
    flagged = kept(candidates(postings(texts, rules), rules), "secret-candidates").withColumnRenamed("key", "flagged_key")
    rows = docs.select(F.struct("*").alias("row"), text_or_empty().alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text")).join(flagged, F.col("key") == F.col("flagged_key"), "left")
    parts = []
    for i, rule in enumerate(rules):
        spans = spans_of(F.col("text"), rule, i)
        if trigram_query(rule.pattern) != ALWAYS:
            spans = F.when(F.array_contains("rules", i), spans)
        parts.append(F.coalesce(spans, F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")))
    others = [F.col("row")[c].alias(c) for c in docs.columns if c != "found"]
    return rows.select(*others, F.sort_array(F.concat(*parts)).alias("found"))


def op3_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(of_kind(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    base = F.filter("found", lambda s: s["order"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPANS_SQL = " UNION ALL ".join(
    f"""
SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, {_quoted(r.pattern)}) AS before,
       regexp_extract_all(t, {_quoted(r.pattern)}) AS matches, regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) AS vals
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"""
    for i, r in enumerate(RULES)
)
OP3_SQL = f"""
WITH found AS ({_SPANS_SQL}),
numbered AS (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM found),
placed AS (
  SELECT doc_id, ord, kind, len(vals[i]) >= least AS ok,
         coalesce(list_sum(list_transform(before[1:i], lambda x: len(x))), 0)
           + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: len(x))), 0) AS start,
         len(matches[i]) AS size
  FROM numbered),
spans AS (SELECT doc_id, ord, kind, start, kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS span FROM placed WHERE ok)
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (WHERE ord < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, ord), '') AS spans
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id
GROUP BY d.doc_id
"""
