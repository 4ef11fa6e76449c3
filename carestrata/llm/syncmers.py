"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the least hash among its s-mers lies at its first or last place. That depends on
the k-mer alone, so an anchor is chosen in every text that holds it, wherever it stands. A text's fingerprint is all its
anchors, each with its first position, in the order of positions; its length grows with the text's (about one anchor in
six code points). The likeness of two fingerprints is the share, among the anchors of both together, of those in both
whose positions keep the same order.

Cases: a null or empty text has the empty fingerprint, alike (1) to an empty one and unlike (0) any other; a text
without anchors (shorter than k, or of few k-mers) has one, the hash of all of it; equal texts have equal fingerprints; a text is never cut.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.arrays import mixed, sliding_min
from carestrata.llm.store import table, text_or_empty

K, S = 16, 5
CHUNK = 1 << 17
NULL_BLOCKS = 64
#: Code points of the texts whose rows are returned at once.
OUT_CHARS = 1 << 21
#: Hash and position of each anchor of one text, by position.
Print = tuple[np.ndarray, np.ndarray]
EMPTY: Print = (np.zeros(0, np.uint32), np.zeros(0, np.uint32))


def anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors among code points, with no regard to where texts begin."""
    n = len(points) - S + 1
    inner = points[:n].astype(np.uint64)
    for j in range(1, S):
        inner = inner * np.uint64(0x100000001B3) + points[j : n + j]
    inner = mixed(inner)
    width = K - S + 1
    least = sliding_min(inner, width)
    place = np.flatnonzero((inner[: len(least)] == least) | (inner[width - 1 :] == least))
    value = inner[place]
    for at, factor in ((S, 0x9E3779B97F4A7C15), (2 * S, 0xC2B2AE3D27D4EB4F), (K - S, 0x165667B19E3779F9)):
        value = value * np.uint64(factor) + inner[place + at]
    return place, (mixed(value) >> np.uint64(32)).astype(np.uint32)


def prints(texts: Sequence[str]) -> list[Print]:
    """Fingerprints of whole texts, worked on in runs of about `CHUNK` code points."""
    out: list[Print] = []
    run: list[str] = []
    size = 0
    for text in texts:
        if run and size + len(text) > CHUNK:
            out += run_prints(run)
            run, size = [], 0
        run.append(text)
        size += len(text)
    return out + run_prints(run)


def run_prints(texts: list[str]) -> list[Print]:
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    place, value = anchors(points) if len(points) >= K else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
    text = np.searchsorted(ends, place, "right")
    inside = place + K <= ends[text] if len(place) else np.zeros(0, bool)
    place, value, text = place[inside], value[inside], text[inside]
    order = np.lexsort((place, value, text))
    place, value, text = place[order], value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    order = np.flatnonzero(fresh)[np.argsort(place[fresh])]
    place, value, text = place[order], value[order], text[order]
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    out = []
    for i, whole in enumerate(texts):
        own = slice(cut[i], cut[i + 1])
        if own.start < own.stop:
            out.append((value[own], (place[own] - (ends[i] - lengths[i])).astype(np.uint32)))
        elif whole:
            digest = hashlib.blake2b(whole.encode(), digest_size=4).digest()
            out.append((np.frombuffer(digest, np.uint32), np.zeros(1, np.uint32)))
        else:
            out.append(EMPTY)
    return out


def written(p: Print) -> str:
    """Eight hex digits of hash and eight of position for each anchor."""
    return np.stack(p, axis=1).astype(">u4").tobytes().hex()


def likeness(a: Print, b: Print) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    shared, here, there = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    places = b[1][there[np.argsort(a[1][here])]]
    rising: list[int] | np.ndarray = places
    if np.any(places[1:] < places[:-1]):
        rising = []
        for there_at in places.tolist():
            i = bisect_left(rising, there_at)
            rising[i : i + 1] = [there_at]
    return len(rising) / (len(a[0]) + len(b[0]) - len(shared))


def fingerprint(text: Column) -> Column:
    """The written fingerprint of each whole text."""

    @F.arrow_udf("string")
    def syncmers(texts: pa.Array) -> pa.Array:
        return pa.array([written(p) for p in prints([t or "" for t in texts.to_pylist()])], pa.string())

    return syncmers(text)


def edit(text: str, following: str) -> str:
    """The last third replaced by as much of the begin of the following text, or all of it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (block, edge, doc_id, text) in order: each row that is no edge, compared with the row after it."""
    held: tuple | None = None  # last row of the batch before: block, edge, id, text, fingerprint
    for batch in batches:
        blocks, edges, ids = (batch.column(i).to_pylist() for i in (0, 1, 2))
        texts = batch.column(3).to_pylist()
        found = prints(texts)
        rows = [(b, e, i, t, p) for b, e, i, t, p in zip(blocks, edges, ids, texts, found)]
        if held is not None:
            rows.insert(0, held)
        held = rows.pop() if rows else held
        # the last row of a block is an edge, whose own comparison isn't wanted
        pairs = [(x, y) for x, y in zip(rows, [*rows[1:], held]) if not x[1]]
        sizes = np.cumsum([len(x[3]) + len(y[3]) for x, y in pairs])
        for _, run in groupby(zip(pairs, (sizes // OUT_CHARS).tolist()), key=lambda r: r[1]):
            yield compared([pair for pair, _ in run])


def compared(pairs: list[tuple[tuple, tuple]]) -> pa.RecordBatch:
    """Rows (block, edge, doc_id, text, fingerprint) with those after them, as `OUT`."""
    edited = [edit(x[3], y[3]) for x, y in pairs]
    edited_prints = prints(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x[2] for x, _ in pairs], pa.int64()),
            pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([written(x[4]) for x, _ in pairs], pa.string()),
            pa.array([written(p) for p in edited_prints], pa.string()),
            pa.array([likeness(x[4], p) for (x, _), p in zip(pairs, edited_prints)], pa.float64()),
            pa.array([likeness(x[4], y[4]) for x, y in pairs], pa.float64()),
        ],
        [c.split()[0] for c in OUT.split(", ")],
    )


def by_descending_id(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, edge, doc_id, text): documents in partitions that hold whole blocks of neighbouring ids, in order.

    Each block ends with an edge row, a copy of the next block's first document (after the last block, of the first), so
    that each document's follower is in its own partition. Order: descending id, null ids last; ties by the hash of the
    text. What the driver gets is the ids that bound blocks, as many as there are blocks.
    """
    order = F.shiftrightunsigned(F.xxhash64("text"), 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("tie", order)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull())
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.25 / blocks)}, reverse=True)
    falling = -np.array(cuts, np.int64)
    last = len(cuts) + 1

    @F.arrow_udf("int")
    def block_of(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(falling, -values.to_numpy(zero_copy_only=False), "left").astype(np.int32))

    heads = ids.select(block_of("doc_id").alias("block"), "doc_id").groupBy("block").agg(F.max("doc_id").alias("head")).collect()
    bound = rows.where(F.col("doc_id").isNull()).select((F.shiftright("tie", 57) + last).cast("int").alias("block"), "tie")
    null_heads = bound.groupBy("block").agg(F.min("tie").alias("head")).collect()
    chain = [(r["block"], False, r["head"]) for r in sorted(heads)] + [(r["block"], True, r["head"]) for r in sorted(null_heads)]
    goes_to = {(null, head): chain[i - 1][0] for i, (_, null, head) in enumerate(chain)}

    @F.arrow_udf("array<struct<block:int,edge:boolean>>")
    def places(values: pa.Array, ties: pa.Array) -> pa.Array:
        out = []
        for value, tie in zip(values.to_pylist(), ties.to_pylist()):
            if value is None:
                own, key = (tie >> 57) + last, (True, tie)
            else:
                own, key = int(np.searchsorted(falling, -value, "left")), (False, value)
            out.append([{"block": own, "edge": False}])
            if key in goes_to:
                out[-1].append({"block": goes_to[key], "edge": True})
        return pa.array(out, pa.list_(pa.struct([("block", pa.int32()), ("edge", pa.bool_())])))

    placed = rows.select("doc_id", "text", "tie", F.explode(places("doc_id", "tie")).alias("at"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.select("at.block", "at.edge", "doc_id", "text", "tie").repartition(parts, "block")
    return dealt.sortWithinPartitions("block", "edge", F.col("doc_id").desc_nulls_last(), "tie").select("block", "edge", "doc_id", "text")


def neighbour_prints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of each document and of its text edited with the next one, in descending id (see `OUT`)."""
    blocks = blocks or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_descending_id(docs, blocks).mapInArrow(compare_neighbours, OUT)


def op2_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return neighbour_prints(table(spark, sf_dir, "documents"))
