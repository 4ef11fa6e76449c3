"""Row counts and load statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_batch(df: DataFrame) -> DataFrame:
    return df.groupBy("META_BATCH_ID").agg(F.count(F.lit(1)).alias("row_count"))


def load_stats(tables: dict[str, DataFrame], batch_id: int) -> DataFrame:
    """Rows of one batch per target table, with the total over all of them as table `TOTAL`."""
    counts = None
    for name, df in tables.items():
        one = df.where(F.col("META_BATCH_ID") == batch_id).agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count"
    )


def volume(files: DataFrame) -> DataFrame:
    """Number, bytes and megabytes of a file inventory."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        (F.coalesce(F.sum("size"), F.lit(0)) / 1048576).alias("megabytes"),
    )
