"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document is contaminated by an item if it holds at least `threshold` of the item's distinct shingles. Plain MinHash
fails here, as a short item is a vanishing part of a long document; so items are partitioned by size (powers of two of
their shingle count n), and only the item is sketched down. Its sketch is its n - ceil(threshold n) + 1 least shingle
hashes: a document without any of these lacks too many shingles, so every contaminated document shares one. From a
document only those hashes count that are no greater than the greatest sketch value of the size partitions it is long
enough for. Pairs that share a sketch value are candidates; their shingles are then compared as words, not as hashes.

Words are runs of letters and digits in lower case. A text of one to four words is one shingle that equals only the
same whole text. A text without words (null, empty, marks) has no shingle: such an item is in no document. A text of any
length is searched whole. Rows with the same id and text are one document, or one item. Null ids are ids like others.
Extra columns are not read, whatever their names. Without documents or without items there are no rows.
All steps are joins and groupings on hashes; Spark broadcasts the sketches only if their written size is small enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table, text_or_empty

SHINGLE, THRESHOLD = 5, 0.8


def worded(rows: DataFrame, id_name: str, id_as: str, copy_as: str) -> DataFrame:
    """Id, hash of the text, words."""
    text = text_or_empty()
    plain = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))
    return (
        rows.select(F.col(id_name).alias(id_as), text.alias("text"))
        .select(id_as, F.xxhash64("text").alias(copy_as), plain.alias("plain"))
        .select(id_as, copy_as, F.when(F.col("plain") == "", F.array().cast("array<string>")).otherwise(F.split("plain", " ")).alias("words"))
    )


def shingles(rows: DataFrame, k: int, as_words: bool = False) -> DataFrame:
    """One row a shingle, repeats included: all columns but `words`, `total` (their number) and `h` or `shingle`."""
    n = F.size("words")
    total = F.greatest(n - (k - 1), F.lit(1))
    placed = rows.select("*", total.alias("total"), F.explode(F.when(n > 0, F.sequence(F.lit(0), total - 1))).alias("i"))
    parts = [F.get("words", F.col("i") + j) for j in range(k)]
    if as_words:
        value = F.concat_ws(" ", *parts).alias("shingle")
        short = F.when(n < k, F.concat(F.lit("whole: "), F.array_join("words", " "))).otherwise(value).alias("shingle")
        return placed.select(*[c for c in rows.columns if c != "words"], "total", short)
    value = F.when(n < k, F.xxhash64(F.lit("whole"), "words")).otherwise(F.xxhash64(*parts))
    return placed.select(*[c for c in rows.columns if c != "words"], "total", value.alias("h"))


def sketches(items: DataFrame, k: int, threshold: float) -> DataFrame:
    """Sketch values: (item_id, item_copy, size_class, need, h); `need` is the least number of shingles to be shared."""
    rows = shingles(items, k).select("item_id", "item_copy", "h").distinct()
    per_item = rows.groupBy("item_id", "item_copy").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    n = F.size("hs")
    need = F.ceil(n * F.lit(threshold) - 1e-9).cast("int")
    return per_item.select(
        "item_id",
        "item_copy",
        F.floor(F.log2(n)).cast("int").alias("size_class"),
        need.alias("need"),
        F.explode(F.slice("hs", F.lit(1), n - need + 1)).alias("h"),
    )


def cut(limits: list, total: Column) -> Column:
    """Greatest sketch value that a document with so many shingles can share; null if it is too short for every item."""
    return reduce(
        lambda best, x: F.greatest(best, F.when(total >= x["need"], F.lit(x["most"]))), limits, F.lit(None).cast("bigint")
    )


def contained(docs: DataFrame, items: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, copy, item_id, n_shared, n_item, containment) of contaminated documents; `copy` hashes the text."""
    doc_words = worded(docs, "doc_id", "doc_id", "copy")
    item_words = kept(worded(items, "item_id", "item_id", "item_copy").distinct(), "bench-items")
    sketch = kept(sketches(item_words, k, threshold), "bench-sketches")
    # one row for each power of two of item lengths: at most 31
    limits = sketch.groupBy("size_class").agg(F.min("need").alias("need"), F.max("h").alias("most")).collect()

    rows = shingles(doc_words, k)
    rows = rows.where(F.col("h") <= cut(limits, F.col("total")))
    found = rows.join(sketch.select("h", "need"), "h").where(F.col("total") >= F.col("need"))
    hits = kept(found.select("doc_id", "copy").distinct(), "bench-hits")
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("copy").alias("hit_copy"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("copy") == F.col("hit_copy"))

    theirs = shingles(item_words, k, as_words=True).select("item_id", "item_copy", "shingle").distinct()
    sizes = theirs.groupBy("item_id", "item_copy").agg(F.count("*").alias("n_item"))
    theirs = theirs.join(sizes.toDF("id", "c", "n_item"), F.col("item_id").eqNullSafe(F.col("id")) & (F.col("item_copy") == F.col("c")))
    theirs = kept(theirs.select("item_id", "item_copy", "n_item", "shingle"), "bench-shingles")
    # distinct before the join, so that nothing above it needs a shingle's rows together and a hot one can be split
    ours = shingles(doc_words.join(hits, same, "left_semi"), k, as_words=True).select("doc_id", "copy", "shingle").distinct()
    counted = ours.join(theirs, "shingle").groupBy("doc_id", "copy", "item_id", "item_copy").agg(
        F.count("*").alias("n_shared"), F.first("n_item").alias("n_item")
    )
    return (
        counted.where(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(threshold) - 1e-9))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
        .select("doc_id", "copy", "item_id", "n_shared", "n_item", "containment")
        .distinct()
    )


def decontaminated(docs: DataFrame, items: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item; all their columns."""
    bad = kept(contained(docs, items, k, threshold).select(F.col("doc_id").alias("bad_id"), F.col("copy").alias("bad_copy")).distinct(), "bench-bad")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(text_or_empty()).alias("copy"))
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("copy") == F.col("bad_copy"))
    return rows.join(bad, same, "left_anti").select("row.*")


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("copy")


def _shingles_sql(source: str, key: str) -> str:
    return f"""
SELECT DISTINCT {key}, CASE WHEN len(w) < {SHINGLE} THEN 'whole: ' || array_to_string(w, ' ')
       ELSE array_to_string(w[i:i + {SHINGLE - 1}], ' ') END AS shingle
FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i
      FROM (SELECT {key}, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
            FROM {source}) WHERE w <> [''])"""


OP7_SQL = f"""
WITH d AS ({_shingles_sql("documents", "doc_id")}),
     b AS ({_shingles_sql("benchmark", "item_id")}),
     sizes AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM d JOIN b USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id
HAVING count(*) >= ceil(any_value(n_item) * {THRESHOLD} - 1e-9)
"""
