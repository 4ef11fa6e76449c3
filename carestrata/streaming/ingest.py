"""Incremental ingest of landed CSV files: the checkpoint remembers what was read, a run takes what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carestrata.operators.merge import BatchStamp

INGEST_ID = "META_INGEST_ID"


def new_files(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    glob: str | None = None,
    files_per_trigger: int | None = None,
    clean: str = "off",
    archive: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Stream of rows from new CSV files, columns bound by position, with the file each row came from.

    clean: "archive" moves consumed files to `archive`, "delete" removes them, each once a later micro-batch with
    data has completed, so never before the rows are published.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.readStream.schema(schema).option("header", "true").option("escape", '"')
    options = {
        "multiLine": str(multiline).lower(),
        "pathGlobFilter": glob,
        "maxFilesPerTrigger": files_per_trigger,
        "cleanSource": clean,
        "sourceArchiveDir": archive if clean == "archive" else None,
    }
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, value)
    return reader.csv(folder).withColumn("META_SOURCE_FILE", F.col("_metadata.file_path"))


def ingest(stream: DataFrame, target: str, checkpoint: str, stamp: BatchStamp) -> StreamingQuery:
    """Append what is new to a bronze table and stop. A micro-batch that is run again replaces its own partition.

    The partition is named by the query and the micro-batch. A query is known by its checkpoint, so another checkpoint,
    or a new one after a loss, never writes over what is there.
    """
    return _ingest(stream, target, checkpoint, stamp, [])


def _ingest(stream: DataFrame, target: str, checkpoint: str, stamp: BatchStamp, done: list[str]) -> StreamingQuery:
    def write(rows: DataFrame, epoch: int) -> None:
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        part = f"{query_id}-{epoch}"
        stamped = stamp.put_on(rows).withColumn(INGEST_ID, F.lit(part))
        writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("META_BATCH_ID", INGEST_ID).parquet(target)
        done.append(part)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def ingest_and_wait(stream: DataFrame, target: str, checkpoint: str, stamp: BatchStamp) -> int:
    """Run to the end of what is there; returns the number of rows taken."""
    done: list[str] = []
    query = _ingest(stream, target, checkpoint, stamp, done)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    if not done:
        return 0
    try:
        written = stream.sparkSession.read.parquet(target)
    except AnalysisException:
        return 0
    return written.where(F.col(INGEST_ID).isin(done)).count()
