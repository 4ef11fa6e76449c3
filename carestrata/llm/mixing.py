"""Mixing sources to target weights by Poisson replication.

A source with weight w and n of the corpus' N rows repeats its rows at the mean rate N w / (n W), W being the weights'
sum over the sources present: the mix then has about N rows, in which every source has its weight's share. How often a
document appears is the value at which the Poisson distribution of that rate passes a uniform number made from a hash
of the seed and the document's id, so the mix is the same on every run and however the rows are dealt. A rate over
`SPLIT` is the sum of equal smaller ones, each with a number of its own, which is the same distribution. Documents are
repeated by their count and dealt and sorted by the hash of each copy: a global shuffle.

The only statistics are the number of rows of each source, summed before they are exchanged. A source may hold any
share of the rows: they're dealt by copy, never by source.

Cases: a null source is a source of its own with the default weight; a weight of zero leaves a source out; weights
below zero are refused. A null id is seeded by its text. Rows with the same id (and text, if null) get the same count;
each is then repeated that often. Null and empty texts are rows like any other. An existing `copy`, `rate` or
`shuffle_key` column is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table, text_or_empty

SEED, SPLIT = "mix-1", 64.0
#: Target weights; a source that is not listed has weight 1.
WEIGHTS = {"src0": 2.0, "src1": 0.5}


def rates(docs: DataFrame, weights: Mapping[str, float], default: float, by: str) -> DataFrame:
    """(group, rate, parts, steps): `steps` holds the distribution function of rate / parts at 0, 1, 2 ..."""
    if min([default, *weights.values()]) < 0:
        raise ValueError("weights must not be below zero")
    sizes = docs.groupBy(F.col(by).alias("group")).agg(F.count("*").alias("n"))
    known = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
    sizes = kept(sizes.withColumn("weight", F.coalesce(known[F.col("group")], F.lit(default))), "mix-sizes")
    whole = sizes.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    rate = F.lit(float(whole["n"] or 0)) * F.col("weight") / (F.lit(whole["weight"] or 1.0) * F.col("n"))
    parted = sizes.withColumn("rate", rate).withColumn("parts", F.greatest(F.ceil(F.col("rate") / SPLIT), F.lit(1)).cast("int"))
    mean = F.col("rate") / F.col("parts")
    return kept(parted.where("rate > 0").select("group", "rate", "parts", distribution(mean).alias("steps")), "mix-rates")


def distribution(mean: Column) -> Column:
    """Poisson distribution function at 0, 1, 2 ... far enough that what is left is below the numbers' resolution."""
    none = F.exp(-mean)
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    walked = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(none.alias("p"), F.array(none).alias("c")),
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"), F.array_append(s["c"], F.element_at(s["c"], -1) + s["p"] * mean / k).alias("c")),
    )
    return walked["c"]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def mixed(
    docs: DataFrame, weights: Mapping[str, float] = WEIGHTS, default: float = 1.0, by: str = "source", seed: str = SEED
) -> DataFrame:
    """The mix: all columns of `docs`, with `rate`, `copy` (1, 2 ...) and `shuffle_key`, in the order of that key."""
    rate = rates(docs, weights, default, by)
    seeded = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text_or_empty())))
    rows = docs.select(F.struct("*").alias("row"), F.col(by).alias("by"), seeded.alias("key"))
    rows = rows.join(rate, F.col("by").eqNullSafe(F.col("group")))
    part = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda j: uniform(F.lit(seed), F.col("key"), j.cast("string"))
    )
    times = F.aggregate(part, F.lit(0), lambda n, u: n + F.size(F.filter("steps", lambda c: c <= u)))
    counted = rows.select("row", "key", "rate", times.alias("times"))
    numbers = F.when(F.col("times") > 0, F.sequence(F.lit(1), F.col("times")))
    copies = counted.select("row", "key", "rate", F.explode(numbers).alias("copy"))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), "key", F.col("copy").cast("string")))
    dealt = copies.select("row", "rate", "copy", order.alias("shuffle_key")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    others = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("rate", "copy", "shuffle_key")]
    return dealt.select(*others, "rate", "copy", "shuffle_key")


def op9_mixing_sources(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


_CASES = " ".join(f"WHEN '{s}' THEN {w}" for s, w in WEIGHTS.items())
OP9_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n, CASE source {_CASES} ELSE 1.0 END::DOUBLE AS weight FROM documents GROUP BY source),
rated AS (
  SELECT source, (SELECT sum(n) FROM sizes)::DOUBLE * weight / ((SELECT sum(weight) FROM sizes) * n) AS rate FROM sizes),
parted AS (SELECT *, greatest(ceil(rate / {SPLIT}), 1)::INTEGER AS parts FROM rated WHERE rate > 0),
steps AS (
  SELECT source, rate, parts, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c FROM parted
  UNION ALL
  SELECT source, rate, parts, k + 1, p * (rate / parts) / (k + 1), c + p * (rate / parts) / (k + 1) FROM steps
  WHERE k < ceil(rate / parts + 12 * sqrt(rate / parts) + 30)),
keyed AS (SELECT *, doc_id::VARCHAR AS key FROM documents),
parts AS (SELECT source, rate, unnest(range(0, parts)) AS j FROM parted),
numbers AS (
  SELECT d.doc_id, d.source, p.rate, ('0x' || substr(md5('{SEED}:' || d.key || ':' || p.j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM keyed d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source),
times AS (
  SELECT n.doc_id, n.rate, count(s.k) AS times
  FROM numbers n LEFT JOIN steps s ON n.source IS NOT DISTINCT FROM s.source AND s.c <= n.u
  GROUP BY n.doc_id, n.rate),
copies AS (SELECT doc_id, rate, unnest(range(1, times + 1))::INTEGER AS copy FROM times)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, round(c.rate, 9) AS rate, c.copy,
       md5('{SEED}:order:' || d.key || ':' || c.copy) AS shuffle_key
FROM keyed d JOIN copies c ON d.doc_id = c.doc_id
"""
