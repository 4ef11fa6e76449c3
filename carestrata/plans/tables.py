"""Where the layers live: batch-partitioned Parquet for bronze and silver, published versions for gold."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.operators.predicates import in_batch
from carestrata.settings import META_SCHEMA, TargetTable

BATCH = "META_BATCH_ID"
DEFAULT_BUCKETS = 512
LOG_SCHEMA = "table string, version bigint, path string, buckets int, batch_id bigint, published_at timestamp"
MANIFEST_SCHEMA = "bucket int, path string, rows bigint"
COMMITS, BUCKET = "_commits", "_bucket"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_if_absent(spark: SparkSession, name: str, columns: Sequence[str]) -> bool:
    """Create an all-text table unless it is there. Returns whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    spark.createDataFrame([], ddl).write.saveAsTable(name)
    return True


def truncate_load(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


create_or_replace_as = truncate_load


def clone_schema_then_insert(spark: SparkSession, template: str, name: str, df: DataFrame) -> None:
    """New table with the columns of another one, then the rows, bound by name."""
    shape = spark.table(template).schema
    spark.createDataFrame([], shape).write.mode("overwrite").saveAsTable(name)
    df.select(*[F.col(f.name).cast(f.dataType) for f in shape]).write.mode("append").saveAsTable(name)


def drop_if_exists(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


class SchemaConflict(ValueError):
    pass


class BatchTable:
    """Bronze or silver: append-only Parquet, one partition per batch.

    Columns may come and go from batch to batch. Every write notes columns that are new in the table's schema log, and
    reads take all columns ever noted, by name, so that no file needs to be opened to know them. A column keeps its type.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._schemas = f"{path}/_schemas"

    def replace(self, df: DataFrame, batch_id: int | None = None) -> None:
        """Write the batches found in `df`, replacing them if they were there: running a batch again leaves one copy.

        With `batch_id`, all rows are of that batch, which is replaced even if there is none. Then the batch's folder has
        one file without rows at least, so that a table that has had no row yet can be read.
        """
        self._note(df.schema)
        if batch_id is not None:
            writer = df.drop(BATCH).write.mode("overwrite").option("partitionOverwriteMode", "static")
            writer.parquet(f"{self.path}/{BATCH}={batch_id}")
            return
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        self._note(df.schema)
        df.write.mode("append").partitionBy(BATCH).parquet(self.path)

    def schema(self) -> T.StructType | None:
        """All columns of all batches in the order they came, without the batch; None for a table without a log."""
        try:
            lines = self.spark.read.text(self._schemas).collect()
        except AnalysisException:
            return None
        noted = sorted((json.loads(r["value"]) for r in lines), key=lambda x: (x["at"], x["id"]))
        fields: dict[str, T.StructField] = {}
        for line in noted:
            for f in T.StructType.fromJson(line["schema"]).fields:
                fields.setdefault(f.name.lower(), f)
        return T.StructType(list(fields.values()))

    def _note(self, schema: T.StructType) -> None:
        """Add the columns that are new to the log; fails on a column that comes with another type."""
        known = {f.name.lower(): f for f in self.schema() or []}
        own = [T.StructField(f.name, f.dataType) for f in schema if f.name != BATCH]
        other = [f"{f.name}: {known[f.name.lower()].dataType.simpleString()}, now {f.dataType.simpleString()}" for f in own if f.name.lower() in known and known[f.name.lower()].dataType != f.dataType]
        if other:
            raise SchemaConflict(f"{self.path} has columns of other types: {', '.join(other)}")
        if fresh := [f for f in own if f.name.lower() not in known]:
            line = {"at": time.time_ns(), "id": uuid.uuid4().hex, "schema": T.StructType(fresh).jsonValue()}
            self.spark.createDataFrame([(json.dumps(line),)], "value string").coalesce(1).write.mode("append").text(self._schemas)

    def read(self, batch_id: int | None = None) -> DataFrame:
        """All batches, or one of them; then only that batch's folder is listed."""
        reader = self.spark.read.option("basePath", self.path)
        if schema := self.schema():
            reader = reader.schema(schema.add(BATCH, T.LongType()))
        else:
            reader = reader.option("mergeSchema", "true")
        try:
            df = reader.parquet(self.path if batch_id is None else f"{self.path}/{BATCH}={batch_id}")
        except AnalysisException:
            df = reader.parquet(self.path)
        df = df.withColumn(BATCH, F.col(BATCH).cast("bigint"))
        return df if batch_id is None else df.where(in_batch(batch_id))

    def contents(self) -> dict[int, str]:
        """Each batch with a digest of its files' names, which differ from write to write; folders are listed, no file read."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = {}
        for folder in system.listStatus(place) if system.exists(place) else []:
            name = folder.getPath().getName()
            if name.startswith(f"{BATCH}=") and name.split("=", 1)[1].isdigit():
                files = sorted(f.getPath().getName() for f in system.listStatus(folder.getPath()))
                files = [f for f in files if not f.startswith(("_", "."))]
                found[int(name.split("=", 1)[1])] = hashlib.sha256(json.dumps(files).encode()).hexdigest()[:32]
        return found

    def drop_batch(self, batch_id: int) -> bool:
        """Take a batch out again. Returns whether it was there."""
        return delete(self.spark, f"{self.path}/{BATCH}={batch_id}")

    def exists(self) -> bool:
        try:
            self.spark.read.parquet(self.path)
        except AnalysisException:
            return False
        return True


class LogTable:
    """Append-only records: audit, lineage, control rows, rule runs."""

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], self.schema)


@dataclass(frozen=True)
class Head:
    """A version: its number, where its manifest is, and its number of buckets."""

    version: int
    path: str | None
    buckets: int


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder of any file system. Returns whether it was there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def commit(spark: SparkSession, root: str, heads: Mapping[str, Head], batch_id: int, at: datetime) -> None:
    """Make versions of any number of gold tables current at once.

    The lines are one file, which the writer renames into place when it is whole: readers see all or none of them.
    """
    rows = [(name, h.version, h.path, h.buckets, batch_id, at) for name, h in sorted(heads.items())]
    if rows:
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/{COMMITS}")


class GoldTable:
    """Current state as published versions, bucketed and sorted by key.

    A version is a manifest: for each bucket the folder that holds it, and its rows. A batch writes only the buckets that
    its keys fall into, to a folder of the new version; the others are taken over by reference. The version becomes
    current by its line in the commit log, alone or together with those of other tables, so readers see either the old
    or the new state, a failed run leaves nothing to undo, and a repeated run overwrites only its own unpublished folder.
    Buckets let the next merge join without exchanging gold.
    """

    def __init__(self, spark: SparkSession, root: str, target: TargetTable, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.root, self.target, self.buckets = spark, root, target, buckets
        self.path = f"{root}/{target.name}"
        self._prefix = f"gold_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}_{target.name.lower()}"
        types = {f.name: f.dataType.simpleString() for f in META_SCHEMA}
        self.ddl = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in target.columns)
        self.schema = T.StructType.fromDDL(self.ddl)

    def log(self) -> DataFrame:
        """Published versions of this table."""
        try:
            lines = self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/{COMMITS}")
        except AnalysisException:
            lines = self.spark.createDataFrame([], LOG_SCHEMA)
        return lines.where(F.col("table") == self.target.name)

    def head(self) -> Head:
        """The published version, read from the log once; version 0 before the first one."""
        row = self.log().orderBy(F.desc("version")).first()
        return Head(row["version"], row["path"], row["buckets"]) if row else Head(0, None, self.buckets)

    def manifest(self, head: Head) -> list[Row]:
        """(bucket, path, rows) of a version's buckets that have rows: one small row a bucket."""
        return self.spark.read.schema(MANIFEST_SCHEMA).json(head.path).orderBy("bucket").collect() if head.path else []

    def bucket_of(self, buckets: int) -> Column:
        """The bucket of a row; the same that Spark's own bucketing gives it."""
        return F.pmod(F.hash(*self.target.keys), F.lit(buckets))

    def touched(self, batch: DataFrame, head: Head) -> list[int]:
        """Buckets that a batch's keys fall into; at most as many numbers as there are buckets."""
        return sorted(r["b"] for r in batch.select(self.bucket_of(head.buckets).alias("b")).distinct().collect())

    def at(self, head: Head, only: Collection[int] | None = None) -> DataFrame:
        """Rows of a version, or of some of its buckets. No bucket is an empty relation, which the optimizer drops from joins."""
        held = [r for r in self.manifest(head) if only is None or r["bucket"] in only]
        if not held:
            typed = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            return self.spark.range(1).where(F.lit(False)).select(*typed)
        which = "" if only is None else "_" + hashlib.sha256(repr([r["bucket"] for r in held]).encode()).hexdigest()[:16]
        name = f"{self._prefix}_v{head.version}{which}"
        drop_if_exists(self.spark, name)
        keys = ", ".join(f"`{k}`" for k in self.target.keys)
        self.spark.sql(
            f"CREATE TABLE {name} ({self.ddl}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {head.buckets} BUCKETS LOCATION '{_quoted(self.path)}/_none'"
        )
        for i in range(0, len(held), 1000):
            parts = " ".join(f"PARTITION ({BUCKET} = {r['bucket']}) LOCATION '{_quoted(r['path'])}'" for r in held[i : i + 1000])
            self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name).select(*self.target.columns)

    def current(self) -> DataFrame:
        return self.at(self.head())

    def rebucket(self, buckets: int, batch_id: int, at: datetime) -> Head:
        """Publish the same rows in another number of buckets, for a table that has outgrown its first one."""
        base = self.head()
        rows = self.at(base).repartition(buckets, *self.target.keys)
        return self.publish(rows, Head(base.version, base.path, buckets), batch_id, at)

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all versions but the last `keep`, of which the newest is the current one. Returns their numbers.

        A bucket's folder goes when no version that stays refers to it.
        """
        if keep < 1:
            raise ValueError("the current version stays")
        known = [Head(r["version"], r["path"], r["buckets"]) for r in self.log().orderBy("version").collect()]
        used = {r["path"] for head in known[-keep:] for r in self.manifest(head)}
        gone = []
        for head in known[:-keep]:
            if not _exists(self.spark, head.path):
                continue
            for path in {r["path"] for r in self.manifest(head)} - used:
                delete(self.spark, path)
            drop_if_exists(self.spark, f"{self._prefix}_v{head.version}")
            delete(self.spark, head.path)  # last, so that a broken expiry is taken up again
            gone.append(head.version)
        return gone

    def stage(self, df: DataFrame, base: Head, touched: Collection[int] | None = None) -> Head:
        """Write the version after `base` without making it current: `df` has all rows of the `touched` buckets, or of all."""
        new = Head(base.version + 1, f"{self.path}/_manifest/v={base.version + 1}", base.buckets)
        folder, name = f"{self.path}/v={new.version}", f"{self._prefix}_staged{new.version}"
        drop_if_exists(self.spark, name)
        delete(self.spark, folder)
        rows = df.select(*self.target.columns, self.bucket_of(new.buckets).alias(BUCKET))
        writer = rows.write.format("parquet").option("path", folder).partitionBy(BUCKET)
        writer.bucketBy(new.buckets, *self.target.keys).sortBy(*self.target.keys).saveAsTable(name)
        written = self.spark.table(name).groupBy(BUCKET).agg(F.count("*").alias("n")).collect()
        held = [] if touched is None else [tuple(r) for r in self.manifest(base) if r["bucket"] not in set(touched)]
        held += [(r[BUCKET], f"{folder}/{BUCKET}={r[BUCKET]}", r["n"]) for r in written]
        self.spark.createDataFrame(held, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(new.path)
        return new

    def publish(self, df: DataFrame, base: Head, batch_id: int, at: datetime, touched: Collection[int] | None = None) -> Head:
        """Write the version after `base` and make it current."""
        new = self.stage(df, base, touched)
        commit(self.spark, self.root, {self.target.name: new}, batch_id, at)
        return new


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
