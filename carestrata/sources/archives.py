"""ZIP archives of any size: listed by their directories, members inflated side by side, all kept as bytes.

A listing reads the end of each archive on the driver where it is larger than `WHOLE`, and the many small ones in tasks,
a few at a time. For the contents, archives are read split by split as raw bytes;
the bytes of each member go to one task in order, which inflates them as a stream. Archives are not held in one piece
anywhere, so they may be larger than a binary value.
"""

from __future__ import annotations

import codecs
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = 1 << 20
ROWS = 4096
#: Archives up to this size are listed by tasks, which read all of them; of larger ones the driver reads the end alone.
WHOLE = 4 << 20
DIRECTORY = "path string, ordinal int, member string, size bigint, start bigint, end bigint, packed bigint, method int, crc bigint, flags int"
CONTENT = "path string, ordinal int, member string, chunk int, content binary, problem string"
#: Names with one of these are patterns to a file reader.
GLOB = re.compile(r"[{}\[\]*?\\]")
STORED, DEFLATED, ENCRYPTED, LOCAL = 0, 8, 1, b"PK\x03\x04"


class _Remote(io.RawIOBase):
    """A file of any Hadoop file system, read where asked; the driver uses it for the directories of archives only."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        self.size, self.at, self.stream = system.getFileStatus(place).getLen(), 0, system.open(place)

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def read(self, n: int = -1) -> bytes:
        n = max(0, self.size - self.at) if n < 0 else min(n, max(0, self.size - self.at))
        if not n:
            return b""
        self.stream.seek(self.at)
        self.at += n
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, n))

    def close(self) -> None:
        self.stream.close()
        super().close()


def _entries(path: str, file: io.IOBase) -> list[tuple]:
    """The rows of `DIRECTORY` of one archive; a member's bytes lie from `start` up to `end`, its own header included."""
    with zipfile.ZipFile(file) as archive:
        infos, end = archive.infolist(), archive.start_dir
    starts = sorted(i.header_offset for i in infos) + [end]
    after = dict(zip(starts, starts[1:]))
    return [
        (path, n, i.filename, i.file_size, i.header_offset, after[i.header_offset], i.compress_size, i.compress_type, i.CRC, i.flag_bits)
        for n, i in enumerate(infos, 1)
    ]


def directory(spark: SparkSession, path: str) -> list[tuple]:
    """The directory of one archive of any size, read by the driver."""
    with _Remote(spark, path) as remote:
        return _entries(path, remote)


def _directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `DIRECTORY` from whole archives (path, content)."""
    types = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.int64(), pa.int32()]
    names = [c.split()[0] for c in DIRECTORY.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = _entries(path, pa.BufferReader(content.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def archive_directory(spark: SparkSession, folder: str, paths: list[str] | None = None) -> DataFrame:
    """Directories of all ZIP archives below a folder, or of those named; no member is inflated."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if paths is None:
        files = reader.option("pathGlobFilter", "*.[zZ][iI][pP]").load(folder)
        paths = sorted(r["path"] for r in files.select("path").collect())
    plain = [p for p in paths if not GLOB.search(p)]
    files = reader.load(plain) if plain else reader.load(folder).where("false")
    small = files.where(F.col("length") <= WHOLE)
    in_tasks = {r["path"] for r in small.select("path").collect()} & set(plain)
    rest = [row for path in paths if path not in in_tasks for row in directory(spark, path)]
    found = spark.createDataFrame(rest, DIRECTORY)
    if not in_tasks:
        return found
    if in_tasks != {r["path"] for r in files.select("path").collect()}:
        named = spark.createDataFrame([(p,) for p in sorted(in_tasks)], "path string")
        small = small.join(F.broadcast(named), "path", "left_semi")
    return small.select("path", "content").mapInArrow(_directories, DIRECTORY).union(found)


def _raw(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Bytes between line feeds, by split; what text is made of them doesn't matter."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, offset, content) in chunks, from (path, base, value) in order."""
    here, offset, held, size = None, 0, [], 0

    def chunk() -> pa.RecordBatch:
        columns = [pa.array([here[0]]), pa.array([offset], pa.int64()), pa.array([b"\n".join([*held, b""])], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["path", "offset", "content"])

    for batch in batches:
        for path, base, value in zip(*(c.to_pylist() for c in batch.columns)):
            if here != (path, base) or size >= CHUNK:
                if held:
                    yield chunk()
                offset = offset + size if here == (path, base) else base
                here, held, size = (path, base), [], 0
            held.append(value)
            size += len(value) + 1
    if held:
        yield chunk()


def _pieces(members: DataFrame, spark: SparkSession) -> DataFrame:
    """The bytes of each member in order: (path, ordinal, member, method, packed, crc, flags, at, content)."""
    from carestrata.sources.records import decoded_path

    paths = sorted(r["path"] for r in members.select("path").distinct().collect())
    raw = _raw(spark, paths)
    sizes = raw.groupBy("path", "block").agg(F.sum(F.octet_length("value") + 1).alias("n"))
    so_far = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row a split; a broadcast leaves the lines of a split in order
    bases = spark.createDataFrame(
        sizes.select("path", "block", F.coalesce(F.sum("n").over(so_far), F.lit(0).cast("bigint")).alias("base")).collect(), "path string, block bigint, base bigint"
    )
    based = raw.join(F.broadcast(bases), ["path", "block"]).select("path", "base", "value")
    chunks = based.mapInArrow(_joined, "path string, offset bigint, content binary")
    forms: dict[str, set[str]] = {}
    for p in paths:
        for form in (p, decoded_path(p)):
            forms.setdefault(form, set()).add(p)
    seen = sorted({r["path"] for r in bases.select("path").collect()})
    as_given = spark.createDataFrame([(k, p) for k in seen for p in sorted(forms.get(decoded_path(k), ()))], "path string, given string")
    ranges = members.withColumnRenamed("path", "given").join(as_given, "given")
    length = F.octet_length("content")
    met = chunks.join(ranges, "path").where((F.col("start") < F.col("offset") + length) & (F.col("end") > F.col("offset")))
    skip = F.greatest(F.col("start") - F.col("offset"), F.lit(0))
    upto = F.least(F.col("end") - F.col("offset"), length)
    cut = F.substring("content", (skip + 1).cast("int"), (upto - skip).cast("int"))
    kept = met.select(F.col("given").alias("path"), "ordinal", "member", "method", "packed", "crc", "flags", (F.col("offset") + skip).alias("at"), cut.alias("content"))
    return kept.repartition("path", "ordinal").sortWithinPartitions("path", "ordinal", "at")


class _Member:
    """Inflates one member as its bytes come."""

    def __init__(self, method: int, packed: int, crc: int, flags: int) -> None:
        self.packed, self.crc, self.sum, self.head = packed, crc, 0, b""
        self.open, self.problem = False, None
        self.unpack = zlib.decompressobj(-15) if method == DEFLATED else None
        if flags & ENCRYPTED:
            self.problem = "encrypted"
        elif method not in (STORED, DEFLATED):
            self.problem = f"compression method {method}"

    def feed(self, data: bytes) -> Iterator[bytes]:
        if self.problem:
            return
        if not self.open:
            self.head += data
            if len(self.head) < 30:
                return
            size = 30 + sum(struct.unpack("<HH", self.head[26:30]))
            if self.head[:4] != LOCAL:
                self.problem = "no member where the directory says"
                return
            if len(self.head) < size:
                return
            data, self.head, self.open = self.head[size:], b"", True
        data, self.packed = data[: self.packed], max(0, self.packed - len(data))
        try:
            while data:
                out = self.unpack.decompress(data, CHUNK) if self.unpack else data
                data = self.unpack.unconsumed_tail if self.unpack else b""
                if out:
                    self.sum = zlib.crc32(out, self.sum)
                    yield out
                elif not data or self.unpack.eof:
                    break
            if self.unpack and not self.packed:
                while out := self.unpack.decompress(self.unpack.unconsumed_tail, CHUNK):
                    self.sum = zlib.crc32(out, self.sum)
                    yield out
        except zlib.error as e:
            self.problem = str(e)

    def verdict(self) -> str | None:
        return self.problem or (None if self.open and self.sum == self.crc else "bytes don't match the checksum")


def _inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `CONTENT`: the chunks of each member, and after them one without content that says whether it was whole."""

    names = [c.split()[0] for c in CONTENT.split(", ")]
    types = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.string()]
    held: list[tuple] = []
    size = 0

    def taken() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
        held.clear()
        return batch

    key, member, n = None, None, 0
    for batch in batches:
        for path, ordinal, name, method, packed, crc, flags, _, content in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (path, ordinal, name):
                if member:
                    held.append((*key, n, None, member.verdict()))
                key, member, n = (path, ordinal, name), _Member(method, packed, crc, flags), 0
            for out in member.feed(content):
                held.append((*key, n, out, None))
                n, size = n + 1, size + len(out)
                if size >= CHUNK or len(held) >= ROWS:
                    yield taken()
                    size = 0
    if member:
        held.append((*key, n, None, member.verdict()))
    if held:
        yield taken()


def member_bytes(spark: SparkSession, members: DataFrame) -> DataFrame:
    """Contents of the members in `members` (rows of `DIRECTORY`), see `CONTENT`: chunks in order, none is left out.

    A member's last row has no content; its `problem` is NULL if all bytes came and fit the checksum, and otherwise says
    what is wrong, also with members that can't be inflated. Directory entries have no bytes.
    """
    return _pieces(members.where(~F.col("member").endswith("/")), spark).mapInArrow(_inflate, CONTENT)


LINES = "path string, ordinal int, member string, line_no bigint, value string"


def _split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of members from the rows of `_inflate`; fails on a member that isn't whole."""
    rest, n = b"", 0

    def rows(key: tuple, first: int, lines: list[bytes]) -> pa.RecordBatch:
        columns = [pa.repeat(pa.scalar(v, t), len(lines)) for v, t in zip(key, (pa.string(), pa.int32(), pa.string()))]
        numbers = pa.array(range(first, first + len(lines)), pa.int64())
        return pa.RecordBatch.from_arrays([*columns, numbers, pa.array(map(decoded, lines), pa.string())], ["path", "ordinal", "member", "line_no", "value"])

    for batch in batches:
        for path, ordinal, name, _, content, problem in zip(*(c.to_pylist() for c in batch.columns)):
            if problem:
                raise ValueError(f"{path}: member {name}: {problem}")
            if content is None:
                lines, rest = ([rest] if rest else []), b""
            else:
                *lines, rest = (rest + content).split(b"\n")
            if lines and not n:
                lines[0] = lines[0].removeprefix(codecs.BOM_UTF8)
            if lines:
                yield rows((path, ordinal, name), n, lines)
            n = 0 if content is None else n + len(lines)


def decoded(line: bytes) -> str:
    """UTF-8, or where a line is not, one character for each byte. Line ends inside quoted values stay as they are."""
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1")


def text_lines(spark: SparkSession, members: DataFrame) -> DataFrame:
    """Lines (`LINES`) of the members in `members`, each member's in one partition and in order."""
    return member_bytes(spark, members).mapInArrow(_split_lines, LINES)
