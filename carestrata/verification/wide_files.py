"""Files as they come: line breaks inside quotes in one large file, folders of several headers, equal names."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.plans.tables import BatchTable
from carestrata.sources.archives import archive_directory, member_bytes
from carestrata.sources.delimited import csv_by_name, csv_strings, csv_to_parquet
from carestrata.sources.files import file_inventory
from carestrata.verification.registry import scratch, table, verify


def _small_splits(spark: SparkSession, folder: str, read, label: str) -> DataFrame:
    """What `read` gives when files are cut into about 64 pieces, of 64 kB at least, written, so that the session is as before
    afterwards."""
    key, path = "spark.sql.files.maxPartitionBytes", scratch(spark, label)
    before = spark.conf.get(key)
    size = file_inventory(spark, folder).agg(F.max("size").alias("n")).first()["n"] or 0
    spark.conf.set(key, f"{max(64 << 10, size // 64)}b")
    try:
        read().write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(path)


@verify("""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderstatus = 'P' THEN 'two' || chr(10) || chr(10) || '"lines"' ELSE o_orderpriority END AS text,
           count(*) OVER () > 5000 AS many_tasks FROM orders
""")
def csv_parallel_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with line breaks inside quotes, read by several tasks, each from where a record begins."""
    broken = F.when(F.col("o_orderstatus") == "P", 'two\n\n"lines"').otherwise(F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"), broken.alias("text"))
    path = scratch(spark, "one-file")
    rows.coalesce(1).write.options(header="true", escape='"').csv(path)
    read = _small_splits(spark, path, lambda: csv_strings(spark, path, multiline=True).withColumn("task", F.spark_partition_id()), "parallel")
    tasks = read.agg(F.count_distinct("task").alias("n")).first()["n"]
    return read.select("key", "text", F.lit(tasks > 2).alias("many_tasks"))


@verify("""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS text, CASE WHEN o_orderstatus = 'P' THEN o_orderstatus END AS more FROM orders
""")
def csv_folder_of_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files have three headers: every file is bound by its own names."""
    orders, path = table(spark, sf_dir, "orders"), scratch(spark, "headers")
    key, text = F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("text")
    parts = {"F": [key, text], "O": [text, key], "P": [F.col("o_orderstatus").alias("more"), key, text]}
    for status, columns in parts.items():
        orders.where(F.col("o_orderstatus") == status).select(*columns).write.option("header", "true").csv(f"{path}/{status}")
    return csv_by_name(spark, path, ["key", "text", "more"])


@verify("SELECT o_orderstatus AS folder, CAST(o_orderkey AS VARCHAR) AS key FROM orders")
def csv_equal_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in several folders copied to Parquet: none takes another's place."""
    path, out = scratch(spark, "stems"), scratch(spark, "stems-parquet")
    files = []
    for status in ("F", "O", "P"):
        rows = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
        rows.select(F.col("o_orderkey").alias("key")).write.option("header", "true").csv(f"{path}/{status}/load.csv")
        files.append(f"{path}/{status}/load.csv")
    parts = [spark.read.parquet(p).select(F.lit(p.split("/")[-2]).alias("folder"), "key") for p in csv_to_parquet(spark, files, out)]
    return reduce(DataFrame.unionByName, parts)


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for doc_id, text in zip(rows["doc_id"], rows["text"]):
            archive.writestr(f"{doc_id}{('.csv', '.psv', '', '.csv.gz')[doc_id % 4]}", text.encode())
    return pd.DataFrame({"archive": rows["archive"][:1], "content": [buffer.getvalue()]})


@verify("SELECT doc_id, md5(coalesce(text, '')) AS bytes_md5, true AS whole FROM documents")
def archive_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in landed archives, as members of several endings or none: listed by directory, all bytes come back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.floor(F.col("doc_id") / 50).alias("archive"))
    path = scratch(spark, "archives")
    packed = docs.groupBy("archive").applyInPandas(_pack, "archive long, content binary")
    packed.select("archive", F.col("content").cast("string")).write.partitionBy("archive").text(path)
    landed = sorted(r["path"] for r in file_inventory(spark, path).where("size > 0 and name like 'part-%'").collect())
    rows = member_bytes(spark, archive_directory(spark, path, landed))
    doc_id = F.regexp_extract("member", r"^(\d+)", 1).cast("bigint").alias("doc_id")
    chunks = F.transform(F.sort_array(F.collect_list(F.struct("chunk", F.col("content").cast("string").alias("content")))), lambda c: c["content"])
    last = F.bool_or(F.col("content").isNull() & F.col("problem").isNull()).alias("whole")
    return rows.groupBy(doc_id).agg(F.md5(F.array_join(chunks, "").cast("binary")).alias("bytes_md5"), last)


@verify("""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS text,
           CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) END AS more,
           CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS META_BATCH_ID FROM orders
""")
def bronze_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: the second one brings a further column, the third one lacks two."""
    orders = table(spark, sf_dir, "orders")
    key, text, more = F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("text"), F.col("o_custkey").cast("string").alias("more")
    bronze = BatchTable(spark, scratch(spark, "evolving"))
    for n, (status, columns) in enumerate({"F": [key, text], "O": [more, key, text], "P": [key]}.items(), 1):
        rows = orders.where(F.col("o_orderstatus") == status).select(*columns, F.lit(n).cast("bigint").alias("META_BATCH_ID"))
        bronze.replace(rows, n)
    return bronze.read().select("key", "text", "more", "META_BATCH_ID")
