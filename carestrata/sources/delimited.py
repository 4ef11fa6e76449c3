"""Delimited text: typed and untyped reads, positional binding, headers, column mappings and record counts."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_READERS = 16


class HeaderMismatch(ValueError):
    pass


def _reader(spark: SparkSession, multiline: bool):
    """Quotes are escaped by doubling. Folders are read as they are: their names give no columns."""
    options = {"header": "true", "escape": '"', "multiLine": str(multiline).lower(), "recursiveFileLookup": "true"}
    return spark.read.options(**options)


def _by_records(spark: SparkSession, path: str | list[str], names: Sequence[str]) -> DataFrame:
    """Columns of files with line breaks inside quotes: their records are found by many tasks, then parsed one by one."""
    from carestrata.sources.records import csv_records

    ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    records = csv_records(spark, path).where(~F.col("first"))
    return records.select(F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"}).alias("r")).select("r.*")


def csv_paths(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files below some paths; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path")
    return sorted(r["path"] for r in files.collect())


def by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], list[str], bool]]:
    """(header, files, multiline) for each header that files below a path have; one pass over them if there are several."""
    from carestrata.sources.records import decoded_path

    profile = csv_profile(spark, path)
    seen = profiled_headers(profile).join(profile.select("path", "multiline"), "path").collect()
    groups: dict[tuple, list] = {}
    for row in sorted(seen, key=lambda r: r["path"]):
        group = groups.setdefault(tuple(row["actual"]), [[], False])
        group[0].append(decoded_path(row["path"]))
        group[1] = group[1] or row["multiline"]
    return [(list(header), files, multiline) for header, (files, multiline) in groups.items()]


def csv_strings(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """All columns as text. Files with different headers are each bound by their own names; a column that a file lacks is
    NULL in its rows. A folder of several files takes a pass over them to read their headers."""
    files = csv_paths(spark, path)
    if len(files) > 1:
        groups = by_header(spark, path)
        if len(groups) > 1:
            parts = [_strings(spark, own, wide) for _, own, wide in groups]
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _strings(spark, path, multiline)


def _strings(spark: SparkSession, path: str | list[str], multiline: bool) -> DataFrame:
    rows = _reader(spark, multiline).csv(path)
    # the multi-line reader leaves a carriage return at the header's end
    names = [c.removesuffix("\r") for c in rows.columns]
    return _by_records(spark, path, names) if multiline and names else rows


def needs_multiline(spark: SparkSession, path: str) -> bool:
    """Whether a quoted line break makes a file unfit for reading split by split."""
    row = csv_profile(spark, path).select(F.max("multiline").alias("m")).first()
    return bool(row and row["m"])


def bind_by_name(df: DataFrame, target: Sequence[str] | T.StructType, case_sensitive: bool = False) -> DataFrame:
    """Columns of `target` taken from `df` by name, missing ones NULL, others left out."""
    fields = target.fields if isinstance(target, T.StructType) else [T.StructField(c, T.StringType()) for c in target]
    have = {c if case_sensitive else c.lower(): c for c in df.columns}

    def pick(f: T.StructField) -> Column:
        source = have.get(f.name if case_sensitive else f.name.lower())
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        return value.cast(f.dataType).alias(f.name)

    return df.select(*[pick(f) for f in fields])


def csv_by_name(
    spark: SparkSession, path: str, target: Sequence[str] | T.StructType, multiline: bool = False, case_sensitive: bool = False
) -> DataFrame:
    return bind_by_name(csv_strings(spark, path, multiline), target, case_sensitive)


def csv_positional(spark: SparkSession, path: str, names: Sequence[str], multiline: bool = False) -> DataFrame:
    """Bind columns by position. Each file must be exactly as wide as the mapping, and all must have one header."""
    width = len(_reader(spark, multiline).csv(path).columns)
    if width != len(names):
        raise HeaderMismatch(f"{path} has {width} columns, the mapping {len(names)}")
    if len(csv_paths(spark, path)) > 1 and len(headers := [h for h, _, _ in by_header(spark, path)]) > 1:
        raise HeaderMismatch(f"{path} has files with different headers: {headers[:3]}")
    if multiline:
        return _by_records(spark, path, names)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _reader(spark, False).schema(schema).csv(path)


REJECTED = "_REJECTED"


def csv_checked(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Types inferred from the data, and `_REJECTED`: the raw record where it does not fit (too short, too long).

    Every record is a row whatever columns are read later, so accepted and rejected rows add up to the record count.
    """
    multiline = needs_multiline(spark, path) if multiline is None else multiline
    schema = _reader(spark, multiline).option("inferSchema", "true").csv(path).schema
    reader = _reader(spark, multiline).schema(schema.add(REJECTED, "string"))
    rows = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, columnPruning="false").csv(path)
    # always true, but it reads every column: Spark refuses to judge a record by its raw text alone
    parsed = F.hash(*[F.col(f"`{f.name}`") for f in schema if f.name != REJECTED]) >= F.lit(-(2**31))
    return rows.where(parsed & (F.col(REJECTED).isNull() | ~F.col(REJECTED).rlike(r"\A[\x00-\x20]*\z")))


def csv_inferred(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """The rows of `csv_checked` that fit."""
    return csv_checked(spark, path, multiline).where(F.col(REJECTED).isNull()).drop(REJECTED)


def csv_rejects(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """The raw records that do not fit, with the file they came from."""
    rows = csv_checked(spark, path, multiline).select("*", F.col("_metadata.file_path").alias("_FILE"))
    return rows.where(F.col(REJECTED).isNotNull()).select("_FILE", REJECTED)


def csv_to_parquet(spark: SparkSession, files: Sequence[str], target: str, multiline: bool = False) -> list[str]:
    """Each file becomes `target/<stem>.parquet`, all columns text; one distributed job per file.

    Files of one name keep as many of their last folders as tell them apart: `a/x.csv` becomes `target/a/x.parquet`.
    """
    parts = [re.sub(r"(?i)\.csv$", "", path.rstrip("/")).split("/") for path in files]
    if len(set(map(tuple, parts))) < len(parts):
        raise ValueError(f"a file is named twice: {sorted(files)}")
    depth = [1] * len(parts)
    while len(set(stems := ["/".join(p[-d:]) for p, d in zip(parts, depth)])) < len(stems):
        depth = [d + (stems.count(s) > 1) for d, s in zip(depth, stems)]
    written = [f"{target}/{stem.lstrip('/')}.parquet" for stem in stems]
    for path, out in zip(files, written):
        wide = multiline or needs_multiline(spark, path)
        csv_strings(spark, path, wide).write.mode("overwrite").parquet(out)
    return written


def add_column_csv(spark: SparkSession, source: str, target: str, name: str, value: Column) -> None:
    csv_strings(spark, source, needs_multiline(spark, source)).withColumn(name, value).write.mode("overwrite").option("header", "true").csv(target)


def csv_headers(spark: SparkSession, paths: Sequence[str], naive: bool = False) -> DataFrame:
    """`path, file_name, object_name, actual` with the column names of each file.

    Only the start of each file is fetched. `naive` splits the first line at every comma, trims, unquotes and drops
    blank names; otherwise the header is read as CSV, also over several lines.
    """

    def header(path: str) -> tuple[str, str, str, list[str]]:
        row = spark.read.option("recursiveFileLookup", "true").text(path).first()
        line = (row[0] if row else "").removeprefix("\ufeff")
        if naive:
            names = [t for t in (x.strip().strip('"').strip() for x in line.split(",")) if t]
        elif line.count('"') % 2:
            names = csv_strings(spark, path, multiline=True).columns
        else:
            names = next(csv.reader([line]), [])
        file_name = path.rstrip("/").rsplit("/", 1)[-1]
        return path, file_name, re.sub(r"\.[^.]*$", "", file_name), names

    with ThreadPool(min(HEADER_READERS, max(1, len(paths)))) as pool:
        rows = pool.map(header, paths)
    return spark.createDataFrame(rows, "path string, file_name string, object_name string, actual array<string>")


def metadata_map(spark: SparkSession, path: str) -> DataFrame:
    """`file_name, columns` from a description file whose two columns go by several names; blanks are skipped."""
    df = csv_strings(spark, path, multiline=True)
    aliases = {
        "file_name": ("FILE_NAME", "FILENAME", "FILE"),
        "columns": ("COLUMNS", "COLUMN", "COLS"),
    }
    found = {}
    for wanted, names in aliases.items():
        match = [c for c in df.columns if c.strip().upper() in names]
        if not match:
            raise HeaderMismatch(f"{path} has no column for {wanted}: {df.columns}")
        found[wanted] = F.trim(F.col(f"`{match[-1]}`"))
    names = F.filter(F.transform(F.split(found["columns"], ","), lambda c: F.trim(c)), lambda c: c != "")
    rows = df.select(found["file_name"].alias("file_name"), names.alias("columns"), found["columns"].alias("_text"))
    rows = rows.where((F.col("file_name") != "") & (F.col("_text") != ""))
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    return numbered.groupBy("file_name").agg(F.max_by("columns", "_at").alias("columns"))


_MAPPING_LINE = re.compile(r'^\s*"?(?P<source>.+?)"?\s+AS\s+(?P<target>[A-Za-z_][A-Za-z0-9_]*)\s*,?\s*$', re.IGNORECASE)


def column_mapping(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(source, target) pairs of a `"Source" AS TARGET,` file, in file order."""
    text = spark.read.text(path, wholetext=True).first()[0]
    pairs = []
    for line in text.splitlines():
        if not line.strip() or line.strip().startswith("--"):
            continue
        match = _MAPPING_LINE.match(line)
        if not match:
            raise ValueError(f"no column mapping in line: {line!r}")
        pairs.append((match["source"], match["target"]))
    return pairs


# --- record counts -----------------------------------------------------------------------------------------
# A physical line maps "inside quotes?" before it to the same after it. Lines are tested for both cases with two
# regular expressions, so every split of a file is summarised on its own and the summaries are then chained.


def quote_patterns(sep: str) -> tuple[str, str]:
    s = re.escape(sep)
    after = rf'(?:[^"{s}][^{s}]*)?'
    cell = rf'(?:"(?:[^"]|"")*"{after}|[^"{s}][^{s}]*|)'
    closed = rf"\A{cell}(?:{s}{cell})*\z"
    closing = rf'\A(?:[^"]|"")*"{after}(?:{s}{cell})*\z'
    return closed, closing


def states(e0: np.ndarray, e1: np.ndarray, start: bool) -> np.ndarray:
    """Inside-quotes flag after each line, from the flag before the first."""
    swaps = np.cumsum(e0 & ~e1)
    at = np.maximum.accumulate(np.where(e0 == e1, np.arange(len(e0)), -1))
    base = np.where(at >= 0, e0[at], start)
    since = swaps - np.where(at >= 0, swaps[at], 0)
    return base ^ (since % 2 == 1)


BLANK = r"\A[\x00-\x20]*\z"  # what the split-by-split reader takes for no record
_ENDS_SCHEMA = "path string, block bigint, end0 boolean, end1 boolean"
_SPLIT_SCHEMA = (
    "path string, block bigint, lines bigint, end0 boolean, records0 bigint, end1 boolean, records1 bigint, header string"
)


def _summarise(sep: str):
    closed, closing = quote_patterns(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for batch in batches:
            value = batch.column("value")
            e0 = ~pc.match_substring_regex(value, closed).to_numpy(zero_copy_only=False)
            e1 = ~pc.match_substring_regex(value, closing).to_numpy(zero_copy_only=False)
            blank = pc.match_substring_regex(value, BLANK).to_numpy(zero_copy_only=False)
            path, block = batch.column("path").to_numpy(zero_copy_only=False), batch.column("block").to_numpy()
            turn = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
            for lo, hi in zip([0, *turn], [*turn, len(block)], strict=True):
                if lo == hi:
                    continue
                entry = seen.setdefault((path[lo], int(block[lo])), [0, False, 0, True, 0, None])
                if not block[lo] and entry[5] is None and (~blank[lo:hi]).any():
                    top = lo + int(np.argmin(blank[lo:hi]))
                    open_after = states(e0[top:hi], e1[top:hi], False)
                    last = top + (int(np.argmin(open_after)) if not open_after.all() else len(open_after) - 1)
                    entry[5] = "\n".join(value[top : last + 1].to_pylist()).removeprefix("\ufeff")
                entry[0] += int((~blank[lo:hi]).sum())
                for k in (1, 3):
                    after = states(e0[lo:hi], e1[lo:hi], entry[k])
                    before = np.concatenate(([entry[k]], after[:-1]))
                    entry[k + 1] += int((~after & ~(blank[lo:hi] & ~before)).sum())
                    entry[k] = bool(after[-1])
        rows = [(*key, *entry) for key, entry in seen.items()]
        names = ["path", "block", "lines", "end0", "records0", "end1", "records1", "header"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
        cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def split_ends(lines: DataFrame, sep: str = ",") -> DataFrame:
    """`path, block, end0, end1` of each split of `lines` (value, path, block): whether it ends inside quotes, if it
    begins outside and if it begins inside."""
    closed, closing = quote_patterns(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list[bool]] = {}
        for batch in batches:
            value = batch.column("value")
            e0 = ~pc.match_substring_regex(value, closed).to_numpy(zero_copy_only=False)
            e1 = ~pc.match_substring_regex(value, closing).to_numpy(zero_copy_only=False)
            path, block = batch.column("path").to_numpy(zero_copy_only=False), batch.column("block").to_numpy()
            turn = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
            for lo, hi in zip([0, *turn], [*turn, len(block)], strict=True):
                if lo < hi:
                    ends = seen.setdefault((path[lo], int(block[lo])), [False, True])
                    ends[:] = [bool(states(e0[lo:hi], e1[lo:hi], end)[-1]) for end in ends]
        columns = list(zip(*[(*k, *v) for k, v in seen.items()])) or [()] * 4
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["path", "block", "end0", "end1"])

    return lines.mapInArrow(run, _ENDS_SCHEMA)


def csv_profile(spark: SparkSession, paths: str | list[str], sep: str = ",") -> DataFrame:
    """`path, file_name, TABLE_NAME, actual_rows, lines, multiline, header` per CSV file.

    Counts logical records (a quoted line break does not end one, blank lines are none) without the header, in
    parallel over the splits of each file. `multiline` tells whether a file needs the single-task reader. Files of
    an extracted archive go by the member's name. `header` is the first record as text.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )
    splits = text.mapInArrow(_summarise(sep), _SPLIT_SCHEMA)
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("bigint").alias("records"))

    def chain(acc: Column, s: Column) -> Column:
        inside = F.when(acc["inside"], s["end1"]).otherwise(s["end0"])
        count = F.when(acc["inside"], s["records1"]).otherwise(s["records0"])
        return F.struct(inside.alias("inside"), (acc["records"] + count).alias("records"))

    per_file = splits.groupBy("path").agg(
        F.sum("lines").alias("lines"),
        F.max("header").alias("header"),
        F.aggregate(
            F.sort_array(F.collect_list(F.struct("block", "end0", "records0", "end1", "records1"))), start, chain
        ).alias("all"),
    )
    records = F.col("all.records") + F.col("all.inside").cast("int")
    decoded = F.url_decode(F.regexp_replace("path", r"\+", "%2B"))
    extracted = F.nullif(F.regexp_extract(decoded, r"/file_name=([^/]+)/", 1), F.lit(""))
    file_name = F.coalesce(extracted, F.substring_index(decoded, "/", -1))
    return per_file.select(
        "path",
        file_name.alias("file_name"),
        F.regexp_replace(file_name, r"(?i)\.csv\z", "").alias("TABLE_NAME"),
        F.greatest(records - 1, F.lit(0)).alias("actual_rows"),
        "lines",
        (F.col("lines") != records).alias("multiline"),
        "header",
    )


def profiled_headers(profile: DataFrame) -> DataFrame:
    """`path, TABLE_NAME, actual` with the column names of each file of a `csv_profile`, read with its one pass."""

    @F.arrow_udf("array<string>")
    def names(headers: pa.Array) -> pa.Array:
        return pa.array([next(csv.reader([h], strict=False), []) if h else [] for h in headers.to_pylist()], pa.list_(pa.string()))

    return profile.select("path", "TABLE_NAME", names("header").alias("actual"))

