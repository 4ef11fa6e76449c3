"""Register of verification queries: each runs library operators over whole given tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carestrata.session import shared_dir, use_engine_conf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def verify(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(use_engine_conf(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared directory for queries that write."""
    return f"{shared_dir(spark)}/verification/{label}-{uuid.uuid4().hex}"


def buckets_for(rows: int, least: int, full: int) -> int:
    """A bucket is one task's to sort and to write, so there are more of them for more rows: one for each `full` rows."""
    return max(least, rows // full)
