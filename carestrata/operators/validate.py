"""Validation of landed files against control counts and registered schemas. Each check is one result row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.operators.predicates import file_matches
from carestrata.settings import FileCriteria


class ValidationFailed(RuntimeError):
    pass


def control_rows(control: DataFrame, batch_id: int, program: str, subject: str) -> DataFrame:
    return control.where(
        (F.col("META_BATCH_ID") == batch_id)
        & (F.col("META_PROGRAM_NAME") == program)
        & (F.col("META_SUBJECT_AREA") == subject)
    ).select("TABLE_NAME", "ROW_COUNT")


def check_row_counts(control: DataFrame, counts: DataFrame, criteria: FileCriteria | None = None) -> DataFrame:
    """`control(TABLE_NAME, ROW_COUNT)` against `counts(TABLE_NAME, actual_rows)`.

    Control rows whose file `<TABLE_NAME>.csv` does not meet the criteria come back as FILTERED.
    """
    name = F.concat("TABLE_NAME", F.lit(".csv"))
    wanted = file_matches(criteria, name) if criteria else F.lit(True)
    actual, expected = F.col("actual_rows"), F.col("expected_rows")
    mismatch = F.concat(F.lit("Row count mismatch: expected "), expected, F.lit(", got "), actual)
    return (
        control.select("TABLE_NAME", F.col("ROW_COUNT").cast("bigint").alias("expected_rows"), wanted.alias("_wanted"))
        .join(counts.select("TABLE_NAME", "actual_rows"), "TABLE_NAME", "left")
        .select(
            F.col("TABLE_NAME").alias("table_name"),
            "expected_rows",
            F.when(F.col("_wanted"), actual).alias("actual_rows"),
            F.when(~F.col("_wanted"), "FILTERED").when(actual == expected, "PASSED").otherwise("FAILED").alias("status"),
            F.when(F.col("_wanted") & actual.isNull(), "File not found")
            .when(F.col("_wanted") & (actual != expected), mismatch)
            .alias("error"),
        )
    )


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for following rows of one object: its name, and the other two columns as lists."""
    for batch in batches:
        if batch.num_rows:
            runs = pc.run_end_encode(batch.column(0))
            at = pa.concat_arrays([pa.array([0], pa.int32()), runs.run_ends])
            lists = [pa.ListArray.from_arrays(at, batch.column(i)) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([runs.values, *lists], ["object_name", "ids", "names"])


def ordered_fields(registry: DataFrame) -> DataFrame:
    """Registered fields of each object as one list in registry order (a list is as long as a table is wide).

    Fields that follow each other are exchanged as one row, with the names as JSON: as text they take a third of the room
    that Spark's arrays of texts do, and a row of its own for each is sorted on both sides of the exchange.
    """
    rows = registry.select(F.col("OBJECT_NAME").alias("object_name"), "ID_OBJECT", "FIELD_NAME")
    of, order, field = [f.dataType.simpleString() for f in rows.schema.fields]
    runs = rows.mapInArrow(_in_runs, f"object_name {of}, ids array<{order}>, names array<{field}>")
    packed = runs.select("object_name", F.struct("ids", F.to_json("names").alias("names")).alias("run"))
    pairs = F.transform(F.collect_list("run"), lambda r: F.arrays_zip(r["ids"].alias("id"), F.from_json(r["names"], f"array<{field}>").alias("name")))
    fields = F.transform(F.sort_array(F.flatten(pairs)), lambda p: p["name"])
    return packed.groupBy("object_name").agg(fields.alias("expected"))


def check_schemas(headers: DataFrame, registry: DataFrame) -> DataFrame:
    """`headers(object_name, actual array)` against the registry; the order of columns counts."""
    expected, actual = F.col("expected"), F.col("actual")
    known = expected.isNotNull()
    differs = known & (actual != expected)
    return (
        headers.select("object_name", F.to_json("actual").alias("listed"))
        .join(ordered_fields(registry), "object_name", "left")
        .withColumn("actual", F.from_json("listed", headers.schema["actual"].dataType))
        .select(
            "object_name",
            F.when(known & (actual == expected), "PASSED").otherwise("FAILED").alias("status"),
            F.when(~known, "No schema definition found").when(differs, "Schema mismatch").alias("error"),
            F.coalesce(F.size(expected), F.lit(0)).cast("bigint").alias("expected_columns"),
            F.when(known, F.size(actual)).cast("bigint").alias("actual_columns"),
            F.when(differs, F.array_except(expected, actual)).alias("missing_columns"),
            F.when(differs, F.array_except(actual, expected)).alias("extra_columns"),
        )
    )


def check_against_metadata(headers: DataFrame, metadata: DataFrame) -> DataFrame:
    """`headers(file_name, actual)` against `metadata(file_name, columns)`; no entry means failed."""
    expected = F.col("columns")
    return headers.join(metadata.select("file_name", "columns"), "file_name", "left").select(
        "file_name",
        "actual",
        F.when(F.col("actual") == expected, "PASSED").otherwise("FAILED").alias("status"),
        F.when(expected.isNull(), "No metadata found")
        .when(F.col("actual") != expected, "Column validation failed")
        .alias("error"),
    )


def tally(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("status") == "FILTERED").alias("filtered_out"),
    )


def require_passed(results: DataFrame, what: str, name: str) -> None:
    """Stop the job if any check failed. The counts are exact, the message names some of the failures."""
    failed = results.where(F.col("status") == "FAILED")
    examples = failed.select(name, "error").take(20)
    if examples:
        total = tally(results).first()["failed"]
        listed = "\n".join(f"  {r[0]}: {r[1]}" for r in examples)
        raise ValidationFailed(f"{what} failed for {total}:\n{listed}")
