"""Batch ids and batch audit rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.functions.cleanse import tolerant_number
from carestrata.operators.predicates import AUDIT_STATES

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("ID_BATCH", T.StringType()),
        T.StructField("PROGRAM_NAME", T.StringType()),
        T.StructField("SUBJECT_AREA", T.StringType()),
        T.StructField("CODE_LOAD_STATUS", T.StringType()),
        T.StructField("DATE_BATCH_LOAD", T.TimestampType()),
        T.StructField("UPDATED_BY", T.StringType()),
    ]
)


def next_batch_ids(audit: DataFrame) -> DataFrame:
    """Next id per program and subject: one above the highest numeric id in use, at least 1."""
    top = F.max(tolerant_number(F.col("ID_BATCH")))
    return (
        audit.where(F.col("CODE_LOAD_STATUS").isin(*AUDIT_STATES))
        .groupBy("PROGRAM_NAME", "SUBJECT_AREA")
        .agg((F.greatest(F.coalesce(top, F.lit(0)), F.lit(0)) + 1).alias("NEXT_ID_BATCH"))
    )


def next_batch_id(audit: DataFrame, program: str, subject: str) -> int:
    own = audit.where((F.col("PROGRAM_NAME") == program) & (F.col("SUBJECT_AREA") == subject))
    row = next_batch_ids(own).first()
    return row["NEXT_ID_BATCH"] if row else 1


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; of several that try at once, one gets True."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    try:
        if system.getUri().getScheme() == "file":  # its create() looks first and writes later
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(place.toUri().getPath()).toPath(), spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            system.create(place, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or system.exists(place):
            return False
        raise
    return True


def claim_batch_id(spark: SparkSession, folder: str, audit: DataFrame, program: str, subject: str) -> int:
    """The next id of a program and subject that no other job has claimed, for this job alone.

    A claim is a file of the id's name. An id whose job died before its first audit row stays claimed and is left out.
    """
    batch_id = next_batch_id(audit, program, subject)
    while not create_once(spark, f"{folder}/{program}/{subject}/{batch_id}"):
        batch_id += 1
    return batch_id


def audit_row(
    spark: SparkSession, batch_id: int, program: str, subject: str, status: str, at: datetime, by: str = "ETL"
) -> DataFrame:
    return spark.createDataFrame([(str(batch_id), program, subject, status, at, by)], AUDIT_SCHEMA)


def run_if_completed(upstream: dict, step: Callable[[], dict]) -> dict:
    """Run a step after a completed one; otherwise report it as skipped."""
    if upstream.get("status") != "completed":
        return {"status": "skipped", "reason": f"upstream is {upstream.get('status', 'unknown')}"}
    return step()


def may_start(state: Mapping, at_least: bool = False) -> bool:
    """Whether a batch may start, from a `set_completeness` row: the set is complete, or `at_least` has enough files."""
    return bool(state["enough"] if at_least else state["complete"] and state["found_total"] == state["expected_total"])
