"""Landed files: inventory, archive members and archive extraction."""

from __future__ import annotations

import codecs
import io
import itertools
import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from datetime import datetime
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.filenames import clean_file_name
from carestrata.functions.releases import DATA_FILE_STEM, data_file_name
from carestrata.operators.predicates import file_matches
from carestrata.settings import FileCriteria
from carestrata.sources.archives import archive_directory, decoded, member_bytes, text_lines

MEMBER_SCHEMA = "path string, ordinal int, member string, size bigint"
LINE_SCHEMA = "path string, ordinal int, member string, line_no bigint, value string"
#: Members with other endings (documents, images) are kept as bytes.
TEXT_ENDINGS = (".csv", ".txt", ".tsv", ".dat")
BYTES_PER_BATCH = 4 * 1024 * 1024


def file_inventory(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """`path, name, size, modified` of all files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    name = F.substring_index("path", "/", -1)
    return reader.load(folder).select(
        "path", name.alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One archive at a time, read where it lies in the batch."""
    types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                rows += [(path, i, m.filename, m.file_size) for i, m in enumerate(archive.infolist(), 1)]
        columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, ["path", "ordinal", "member", "size"])


def list_members(archives: DataFrame) -> DataFrame:
    """Members of ZIP archives given as `path, content`."""
    return archives.select("path", "content").mapInArrow(_list_members, MEMBER_SCHEMA)


def archive_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of every ZIP below a folder, in archive order (directory entries end in '/'); only directories are read."""
    return archive_directory(spark, folder).select("path", "ordinal", "member", "size")


def _lines_of(archive: zipfile.ZipFile, path: str, wanted: str) -> Iterator[pa.RecordBatch]:
    for ordinal, info in enumerate(archive.infolist(), 1):
        if not info.filename.lower().endswith(TEXT_ENDINGS) or not re.search(wanted, info.filename):
            continue
        with archive.open(info) as raw:
            number = 0
            while lines := raw.readlines(BYTES_PER_BATCH):
                n = len(lines)
                if not number:
                    lines[0] = lines[0].removeprefix(codecs.BOM_UTF8)
                value = [decoded(line.removesuffix(b"\n")) for line in lines]
                columns = [
                    pa.repeat(pa.scalar(path, pa.string()), n),
                    pa.repeat(pa.scalar(ordinal, pa.int32()), n),
                    pa.repeat(pa.scalar(info.filename, pa.string()), n),
                    pa.array(np.arange(number, number + n, dtype=np.int64)),
                    pa.array(value, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "ordinal", "member", "line_no", "value"])
                number += n


def _read_lines(batches: Iterator[pa.RecordBatch], wanted: str = "") -> Iterator[pa.RecordBatch]:
    """Lines of small members share a batch, large members come in several."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                for lines in _lines_of(archive, path, wanted):
                    held.append(lines)
                    size += lines.nbytes
                    if size >= BYTES_PER_BATCH:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def member_lines(archives: DataFrame, wanted: str = "") -> DataFrame:
    """Text lines of the members of archives given as `path, content` whose name matches `wanted`, inflated as a
    stream: a task holds one archive and one batch of lines."""
    return archives.select("path", "content").mapInArrow(partial(_read_lines, wanted=wanted), LINE_SCHEMA)


def extract_archives(
    spark: SparkSession, folder: str, target: str, criteria: FileCriteria | None = None, wanted: str = ""
) -> list[str]:
    """Write each text member to `target/file_name=<cleaned name>/member=<id>/`, its lines in order, in one file.

    Members whose cleaned names are equal stay apart, each with its own header. Directory entries are skipped. With
    `criteria`, only archives whose name fits are opened, and of them only members that match `wanted` are inflated.
    Members with other endings than text has are kept as bytes in the table `target.members` (see `archives.CONTENT`);
    their names are returned. A member that doesn't come whole fails the extraction. Nothing of an earlier extraction to
    the same folder is left.
    """
    archives = file_inventory(spark, folder, "*.[zZ][iI][pP]")
    if criteria is not None:
        archives = archives.where(file_matches(criteria, F.substring_index("path", "/", -1)))
    paths = sorted(r["path"] for r in archives.select("path").collect())
    members = archive_directory(spark, folder, paths).where(F.col("member").rlike(wanted) & ~F.col("member").endswith("/"))
    is_text = F.lower("member").rlike("(" + "|".join(re.escape(e) for e in TEXT_ENDINGS) + r")\z")
    named = text_lines(spark, members.where(is_text)).select(
        clean_file_name(F.substring_index("member", "/", -1)).alias("file_name"),
        F.concat_ws("-", F.md5("path"), "ordinal").alias("member"),
        "line_no",
        "value",
    )
    ordered = named.sortWithinPartitions("file_name", "member", "line_no").drop("line_no")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file_name", "member").text(target)
    others = members.where(~is_text)
    names = [r["member"] for r in others.select("member").collect()]
    if names:
        content = member_bytes(spark, others)
        content.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target}.members")
    return names


def first_member(members: DataFrame, stem: str) -> DataFrame:
    """Per archive the first `<stem>_*.csv` member that is no header file."""
    wanted = (
        F.col("member").startswith(f"{stem}_")
        & F.col("member").endswith(".csv")
        & ~F.lower("member").contains("header")
    )
    return members.where(wanted).groupBy("path").agg(F.min_by("member", "ordinal").alias("member"))


def not_loaded(releases: DataFrame, files: DataFrame, as_of: datetime) -> DataFrame:
    """Releases (`name`) with no data file yet, neither under the standard name nor for the same days (`files.name`)."""
    stamp = F.lit(int(as_of.timestamp()))
    known = F.regexp_extract("name", r"(\d{8}-\d{8})", 1)
    data = files.where(F.col("name").endswith(".csv") & F.col("name").contains(DATA_FILE_STEM))
    periods = data.where(known != "").select(known.alias("_period")).distinct()
    names = files.select(F.col("name").alias("_file")).distinct()
    keyed = releases.withColumn("_file", data_file_name(F.col("name"), stamp))
    keyed = keyed.withColumn("_period", F.regexp_extract("_file", r"(\d{8}-\d{8})", 1))
    return keyed.join(names, "_file", "left_anti").join(periods, "_period", "left_anti").drop("_file", "_period")


def not_present(files: DataFrame, there: DataFrame) -> DataFrame:
    """Files whose name is not at the destination yet."""
    return files.join(there.select("name").distinct(), "name", "left_anti")


def put_away(spark: SparkSession, path: str, folder: str, moves: str | None = None) -> str:
    """Move a consumed file into a folder of its file system; returns where it is now.

    With `moves`, what is to be done is written there first and taken out when it is done, so that `finish_moves` can
    finish what a crash left open. A file of the same name that is there already, from another delivery, stays: the new
    one gets a number before its ending.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(path)
    system = source.getFileSystem(conf)
    system.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    stem, dot, ending = source.getName().rpartition(".") if "." in source.getName() else (source.getName(), "", "")
    names = itertools.chain([source.getName()], (f"{stem}.{n}{dot}{ending}" for n in itertools.count(1)))
    target = next(t for t in (jvm.org.apache.hadoop.fs.Path(folder, n) for n in names) if not system.exists(t))
    if moves is None:
        if not system.rename(source, target):
            raise OSError(f"{path} could not be moved to {folder}")
        return target.toString()
    intent = {"source": path, "target": target.toString(), "size": system.getFileStatus(source).getLen()}
    record = jvm.org.apache.hadoop.fs.Path(moves, f"{uuid.uuid4().hex}.json")
    system_of_moves = record.getFileSystem(conf)
    out = system_of_moves.create(record, False)
    out.write(bytearray(json.dumps(intent).encode()))
    out.close()
    return _move(spark, record)


def _move(spark: SparkSession, record) -> str:
    """Do what a record says, as far as it isn't done, and take the record out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    records = record.getFileSystem(conf)
    stream = records.open(record)
    text = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    try:
        intent = json.loads(text)
    except ValueError:  # the writer died before it was whole, so nothing was moved
        records.delete(record, False)
        return ""
    source, target = (jvm.org.apache.hadoop.fs.Path(intent[k]) for k in ("source", "target"))
    system = source.getFileSystem(conf)
    if system.exists(source) and system.exists(target):
        # stores that move by copying: only a whole copy replaces the source
        if system.getFileStatus(target).getLen() == intent["size"] == system.getFileStatus(source).getLen():
            system.delete(source, False)
        else:
            system.delete(target, False)
    if system.exists(source):
        system.mkdirs(target.getParent())
        if not system.rename(source, target):
            raise OSError(f"{intent['source']} could not be moved to {intent['target']}")
    elif not system.exists(target):
        raise OSError(f"{intent['source']} is neither there nor at {intent['target']}")
    records.delete(record, False)
    return target.toString()


def finish_moves(spark: SparkSession, moves: str) -> list[str]:
    """Finish the moves that a crash left open; returns where the files are now."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(moves)
    system = folder.getFileSystem(conf)
    if not system.exists(folder):
        return []
    records = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().endswith(".json")]
    return [done for r in sorted(records, key=lambda r: r.getName()) if (done := _move(spark, r))]
