"""From raw documents to a training mix: each stage works on all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again for the next.

Cases, for all stages: a null text counts as an empty one and stays null where its document stays; a text of any length is
worked on whole; null ids are documents like others; repeated rows are judged alike, and near-dedup leaves one of them;
of equal documents the one of least id stays; an empty table, or a stage that keeps nothing, gives no rows; all stages but
the last return the columns they got, further ones and whatever names they have included (`n_chars`, where there is one,
follows the text). What the operators state for themselves holds too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.llm.decontaminate import decontaminated
from carestrata.llm.line_dedup import dedup_lines
from carestrata.llm.mixing import mixed
from carestrata.llm.quality import judge
from carestrata.llm.simhash import without_near_duplicates
from carestrata.llm.store import kept, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    judged = judge(docs, table(spark, sf_dir, "labels"))
    return judged.where(F.col("predicted") == 1).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier; a document left with no line at all goes."""
    done = dedup_lines(docs)
    left = done.where((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    return counted(left, docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of four words, at most four bits apart."""
    return without_near_duplicates(docs, shingle=4, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target weight, in a global random order."""
    return mixed(docs)


def counted(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with the length of the changed text where there is such a column."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed_sources),
]

ORACLE_SQL = None  # the classifier's weights have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
