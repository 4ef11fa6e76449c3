"""Files into catalog tables, created from the data where they do not exist."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from carestrata.operators.merge import BatchStamp
from carestrata.plans.tables import drop_if_exists, table_exists, truncate_load
from carestrata.sources.columnar import file_tables, fold_names, parquet_into, with_provenance
from carestrata.sources.delimited import csv_inferred, csv_rejects


def load_csv(spark: SparkSession, path: str, table: str, mode: str = "replace") -> int:
    """Typed load of a CSV file; mode "replace" or "append". Returns the table's row count.

    Records that do not fit are kept as text in `<table>_REJECTS`, which is there only if there are any.
    """
    count = _write(spark, csv_inferred(spark, path), table, mode)
    rejects = csv_rejects(spark, path)
    if not rejects.isEmpty():
        _write(spark, rejects, f"{table}_REJECTS", mode)
    elif mode == "replace":
        drop_if_exists(spark, f"{table}_REJECTS")
    return count


def load_parquet(spark: SparkSession, path: str, table: str, mode: str = "append") -> int:
    """Load by column name in any letter case; columns the file lacks are NULL."""
    existing = spark.table(table).schema if table_exists(spark, table) else None
    rows = parquet_into(spark, path, existing)
    if existing is not None:
        rows = rows.select(*[c.upper() for c in existing.names])
    return _write(spark, rows, table, mode)


def load_each(
    spark: SparkSession, paths: Sequence[str], prefix: str = "", database: str = "default", stamp: BatchStamp | None = None
) -> dict[str, int]:
    """Every Parquet file whose name has the prefix, appended to the table of its own name."""
    wanted = {t: p for t, p in file_tables(paths).items() if t.startswith(prefix)}
    counts = {}
    for table, files in wanted.items():
        rows = _together([fold_names(spark.read.parquet(path)) for path in files])
        counts[table] = _write(spark, stamp.put_on(rows) if stamp else rows, f"{database}.{table}", "append")
    return counts


def create_each(
    spark: SparkSession, paths: Sequence[str], suffix: str, loaded_at: datetime, database: str = "default"
) -> dict[str, int]:
    """Every Parquet file as a new table `<stem><suffix>`, with the file and time each row came from."""
    counts = {}
    for table, files in file_tables(paths, suffix).items():
        rows = _together([with_provenance(spark.read.parquet(path), loaded_at) for path in files])
        counts[table] = _write(spark, rows, f"{database}.{table}", "replace")
    return counts


def _together(parts: list[DataFrame]) -> DataFrame:
    """Files of one table name, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _write(spark: SparkSession, rows: DataFrame, table: str, mode: str) -> int:
    if mode not in ("replace", "append"):
        raise ValueError("mode is 'replace' or 'append'")
    if mode == "replace" or not table_exists(spark, table):
        truncate_load(rows, table)
    else:
        rows.write.mode("append").saveAsTable(table)
    return spark.table(table).count()
