"""Parquet loads: by name, one table per file, with provenance columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.operators.merge import BatchStamp
from carestrata.sources.delimited import bind_by_name


def fold_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def parquet_into(spark: SparkSession, path: str, existing: T.StructType | None) -> DataFrame:
    """Rows of a Parquet source with upper-cased names, aligned by name with a table that may lack columns."""
    new = fold_names(spark.read.parquet(path))
    if existing is None:
        return new
    return fold_names(spark.createDataFrame([], existing)).unionByName(new, allowMissingColumns=True)


def parquet_by_name(spark: SparkSession, path: str, target: Sequence[str], stamp: BatchStamp) -> DataFrame:
    return stamp.put_on(bind_by_name(spark.read.parquet(path), target))


def with_provenance(df: DataFrame, loaded_at: datetime) -> DataFrame:
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_loaded_at": F.lit(loaded_at)})


def file_tables(paths: Sequence[str], suffix: str = "") -> dict[str, list[str]]:
    """Table name -> its files. A file becomes the table named by its stem, with `suffix` unless it already ends so."""
    out: dict[str, list[str]] = {}
    for path in paths:
        base = path.rstrip("/").rsplit("/", 1)[-1]
        stem = base[: -len(".parquet")] if base.lower().endswith(".parquet") else base
        out.setdefault(stem if stem.endswith(suffix) else stem + suffix, []).append(path)
    return out
