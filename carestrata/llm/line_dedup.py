"""Line dedup: winnowing over line hashes, and deletion of runs of lines that stand earlier in the corpus.

A run of lines is repeated if the same lines stand at an earlier place and hold `min_words` words or more; all lines of
the longest such runs go, of which each line therefore stands earlier, next to the same neighbours.

Windows are the fewest lines that hold `min_words` words, from some line on or up to some line. A window's least line
hash is its fingerprint. Any repeated run holds a whole window, so its places share a fingerprint: none can be missed.
Positions of fingerprints that occur twice are joined with the windows around them; windows of equal lines match.
Matches extend each other both ways to the whole run: a run's windows from each line on reach its begin, its windows up
to each line reach its end, and together they cover every line of it, a last line of one word too. Of equal places, the
one with the least (doc_id, position) stays and all later ones are deleted, within a document too.

The order of documents is (doc_id, hash of the text), null ids first. Lines are compared without outer spaces; blank
lines count as one word. Rows with the same id and text are one document and are treated alike. A null text has one
blank line and stays null. A document of fewer words than a window never loses a line; a text of any length is cut into
lines, of which a window holds at most `min_words`. An empty table gives no rows. Other columns stay, whatever their
names, but for `n_lines` and `n_deleted`, which are replaced. All work is on line rows and on windows, never on pairs of
documents: a line that a third of the corpus shares costs one row for each place it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table, text_or_empty

MIN_WORDS = 8


def lines_of(docs: DataFrame) -> DataFrame:
    """One row a line: document, position, two hashes, number of words."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("copy"), F.split("text", "\n").alias("parts"))
    rows = rows.select("doc_id", "copy", F.posexplode("parts").alias("pos", "line"))
    line = F.trim("line")
    return rows.select(
        "doc_id",
        "copy",
        "pos",
        F.xxhash64(line).alias("h"),
        F.xxhash64(F.lit("second"), line).alias("h2"),
        (F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1).cast("long").alias("words"),
    )


def windows_of(lines: DataFrame, min_words: int) -> DataFrame:
    """One row a window: its first and last line, the fingerprint's hash and position, and a 128-bit digest of its lines."""
    doc = Window.partitionBy("doc_id", "copy")
    once = lines.repartition("doc_id", "copy").dropDuplicates(["doc_id", "copy", "pos"])
    placed = once.withColumn("upto", F.sum("words").over(doc.orderBy("pos")))
    placed = placed.withColumn("before", F.col("upto") - F.col("words")).withColumn("total", F.sum("words").over(doc))

    def content(span: WindowSpec) -> Column:
        return F.struct(
            F.min("pos").over(span).alias("pos"),
            F.max("pos").over(span).alias("last"),
            F.min("before").over(span).alias("before"),
            F.min(F.struct("h", "pos")).over(span).alias("mark"),
            F.collect_list("h").over(span).alias("hs"),
            F.collect_list("h2").over(span).alias("h2s"),
        )

    onward = content(doc.orderBy("before").rangeBetween(Window.currentRow, min_words - 1))
    upward = content(doc.orderBy("upto").rangeBetween(1 - min_words, Window.currentRow))
    both = placed.select(
        "doc_id",
        "copy",
        F.when(F.col("before") + min_words <= F.col("total"), onward).alias("onward"),
        F.when(F.col("upto") >= min_words, upward).alias("upward"),
        F.col("before").alias("here"),
    )
    # a window up to a line that needs all of its lines is also one from its first line on
    further = F.when(F.col("here") - F.col("upward.before") >= min_words, F.col("upward"))
    rows = both.select("doc_id", "copy", F.explode(F.filter(F.array("onward", further), lambda w: w.isNotNull())).alias("w"))
    return rows.select(
        "doc_id",
        "copy",
        "w.pos",
        "w.last",
        F.col("w.mark.h").alias("mark"),
        F.col("w.mark.pos").alias("mark_pos"),
        F.struct(F.xxhash64("w.hs").alias("a"), F.xxhash64("w.h2s").alias("b")).alias("digest"),
    )


def repeated_runs(windows: DataFrame) -> DataFrame:
    """Runs of lines of each document that stand earlier: (doc_id, copy, runs as ordered {first, last})."""
    place = F.struct("doc_id", "copy", "mark_pos")
    marks = windows.groupBy("mark").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    twice = kept(marks.where(~F.col("lo").eqNullSafe(F.col("hi"))).select("mark"), "line-marks")
    around = windows.join(twice, "mark", "left_semi")
    at = F.struct("doc_id", "copy", "pos")
    ends = around.groupBy("digest").agg(F.min(at).alias("earliest"), F.max(at).alias("latest"))
    firsts = kept(ends.where(~F.col("earliest").eqNullSafe(F.col("latest"))).select("digest", "earliest"), "line-firsts")
    later = around.join(firsts, "digest").where(~at.eqNullSafe(F.col("earliest"))).select("doc_id", "copy", "pos", "last")

    doc = Window.partitionBy("doc_id", "copy")
    reach = F.max("last").over(doc.orderBy("pos", "last").rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("pos") <= reach + 1, 0).otherwise(1)
    numbered = later.withColumn("begins", begins).withColumn("run", F.sum("begins").over(doc.orderBy("pos", "last")))
    runs = numbered.groupBy("doc_id", "copy", "run").agg(F.min("pos").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the later repeats deleted from `text`, and `n_lines`, `n_deleted`; other columns are left as they are."""
    runs = kept(repeated_runs(kept(windows_of(lines_of(docs), min_words), "line-windows")), "line-runs")
    runs = runs.select(F.col("doc_id").alias("run_id"), F.col("copy").alias("run_copy"), "runs")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(text_or_empty()).alias("copy"))
    joined = rows.join(runs, F.col("doc_id").eqNullSafe(F.col("run_id")) & (F.col("copy") == F.col("run_copy")), "left")
    parts = F.split(F.coalesce(F.col("row.text"), F.lit("")), "\n")
    # what lies between the runs: from the end of one to the begin of the next
    froms = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["last"] + 1))
    tos = F.concat(F.transform("runs", lambda r: r["first"]), F.array(F.size("parts")))
    pieces = F.transform(F.arrays_zip(froms.alias("a"), tos.alias("b")), lambda g: F.slice("parts", g["a"] + 1, g["b"] - g["a"]))
    gone = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    text = F.when(F.col("runs").isNull() | F.col("row.text").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(pieces), "\n"))
    done = joined.select("row", "runs", parts.alias("parts")).select(
        "row", text.alias("text"), F.size("parts").alias("n_lines"), F.coalesce(gone, F.lit(0)).alias("n_deleted")
    )
    others = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("text", "n_lines", "n_deleted")]
    return done.select(*others, "text", "n_lines", "n_deleted")


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)


OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
counted AS (
  SELECT doc_id, pos, trim(line) AS t, len(trim(line)) - len(replace(trim(line), ' ', '')) + 1 AS words FROM lines),
pairs AS (
  SELECT b.doc_id, b.pos, b.words, a.doc_id AS earlier, b.pos - a.pos AS shift
  FROM counted a JOIN counted b ON a.t = b.t AND (a.doc_id, a.pos) < (b.doc_id, b.pos)),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, earlier, shift ORDER BY pos) AS run FROM pairs),
weighed AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, earlier, shift, run) AS total FROM runs),
gone AS (SELECT DISTINCT doc_id, pos FROM weighed WHERE total >= {MIN_WORDS})
SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text,
       CAST(count(*) AS INTEGER) AS n_lines, CAST(count(g.pos) AS INTEGER) AS n_deleted
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
GROUP BY l.doc_id
"""
