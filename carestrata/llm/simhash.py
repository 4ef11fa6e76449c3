"""SimHash near-dedup with BK-trees.

A fingerprint holds 64 majority bits over the XXH64 hashes of a text's word shingles. Fingerprints that differ in at
most `radius` bits are linked. Equal texts share a fingerprint, and the search works on distinct fingerprints only.

Search. Cut 64 bits into radius + 2 blocks: two fingerprints within the radius agree in at least two whole blocks. So
each fingerprint is sent once to the shard of every pair of blocks, and every link lies inside some shard. A shard's
fingerprints become a BK-tree (children keyed by their Hamming distance to the parent), and each of its members is
looked up following only edges within the radius. A shard of more than `shard_size` fingerprints is parted once more:
its other bits are cut into radius + 1 blocks, one of which agrees in every link. What is larger still is dealt into
slices; the tree of each slice is then given to every other slice's lookups, so no task holds more than two slices. A shard
emits the links that join its members, at most one a member, never all pairs: other links within it add no connection.

Cases: a null or empty text, or one of white space, has fingerprint zero, which is linked like any other. Fewer words
than a shingle make one shingle of all words. A text of any length counts whole. Repeated rows share everything. A null id
never names a component; a component in which all ids are null has a null id. An empty table gives no rows. Only doc_id
and text are read; the filter keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.arrays import SPACE, WORD, byte_classes, chunks, flat, lower_bytes
from carestrata.llm.components import components
from carestrata.llm.store import kept, table, text_or_empty

SHINGLE, RADIUS, SHARD_SIZE = 4, 4, 2048
SEED = 42

NOT_SPACE = np.where(byte_classes() == SPACE, SPACE, WORD).astype(np.uint8)
FOLD = lower_bytes()
FOLD[9:14] = 32


def shingle_hashes(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle of each text, and for each text the place of its first shingle."""
    kind = NOT_SPACE[data]
    word = kind != SPACE
    begins = word.copy()
    begins[1:] &= kind[:-1] == SPACE
    inner = at[:-1][at[:-1] < len(data)]
    begins[inner] = word[inner]
    ends = word.copy()
    ends[:-1] &= kind[1:] == SPACE
    last = at[1:][at[1:] > 0] - 1
    ends[last] = word[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    count = np.diff(first)
    # squeeze white space to single blanks between words of one text
    held = word.copy()
    not_first = np.ones(len(start), bool)
    not_first[first[:-1][count > 0]] = False
    held[start[not_first] - 1] = True
    moved = np.cumsum(held) - 1
    buffer = FOLD[data[held]].tobytes()
    s, e = moved[start], moved[end - 1] + 1
    number = np.arange(len(start)) - np.repeat(first[:-1], count)
    room = np.repeat(count, count) - number
    opens = np.flatnonzero((room >= k) | (number == 0))
    closes = np.minimum(opens + k, np.repeat(first[1:], count)[opens]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(buffer[i:j], SEED) for i, j in zip(s[opens].tolist(), e[closes].tolist())], np.uint64)
    return hashes, np.searchsorted(opens, first)


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit value a text: the bits set in over half of its hashes."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, first[full], axis=0, dtype=np.int32)
        most = 2 * sums > np.diff(first)[full][:, None]
        out[full] = np.packbits(most, axis=1).view(np.uint64)[:, 0]
    return out


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """64-bit fingerprint of each whole text, as a signed long."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        raw, at = flat(texts)
        out = np.zeros(len(texts), np.uint64)
        for i, j, data, places in chunks(raw, at):
            if len(data):
                out[i:j] = majority(*shingle_hashes(data, places, shingle))
        return pa.array(out.view(np.int64))

    return simhash(text)


class BKTree:
    """Distinct 64-bit values; each child hangs under the distance to its parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while at != new:
            at = self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the values at most `radius` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            below = self.children[at]
            if below:
                todo.extend(below[x] for x in range(d - radius, d + radius + 1) if x in below)
        return found


def joining_links(tree_of: list[int], lookups: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links between two slices, or within one if the second is empty, that join what no earlier link has joined."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (above := root.get(x, x)) != x:
            root[x] = x = root.get(above, above)
        return x

    tree = BKTree()
    for value in tree_of:
        if not lookups:
            for n in tree.within(value, radius):
                a, b = top(value), top(tree.values[n])
                if a != b:
                    root[a] = b
                    yield value, tree.values[n]
        tree.add(value)
    for value in lookups:
        for n in tree.within(value, radius):
            a, b = top(value), top(tree.values[n])
            if a != b:
                root[a] = b
                yield value, tree.values[n]


GROUP = ["pair", "block", "sub", "part", "low", "high"]


def bit_blocks(bits: list[int], n: int) -> list[int]:
    """Masks of n blocks of about equal size of these bits, as signed longs."""
    width = [len(bits) // n + (i < len(bits) % n) for i in range(n)]
    masks = [sum(1 << b for b in bits[sum(width[:i]) : sum(width[: i + 1])]) for i in range(n)]
    return [m - (m >> 63 << 64) for m in masks]


def shards(prints: DataFrame, radius: int, shard_size: int) -> DataFrame:
    """One row for each lookup group a fingerprint takes part in: GROUP, looks_up, fp.

    Linked fingerprints agree in two of radius + 2 blocks of bits. Where more than `shard_size` agree in two, the other
    bits are parted once more: links differ in at most `radius` of these, so they agree in one of radius + 1 blocks. What
    is larger still is dealt into slices, each of which meets each other one.
    """
    masks = [a | b for a, b in combinations(bit_blocks(list(range(64)), radius + 2), 2)]
    rest = [bit_blocks([b for b in range(64) if not m >> b & 1], radius + 1) for m in masks]
    pairs = F.array(*[F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("block")) for i, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(pairs).alias("shard")).select("fp", "shard.pair", "shard.block")
    over = F.col("size") > shard_size
    sizes = rows.groupBy("pair", "block").agg(F.count("*").alias("size")).where(over)
    hot = kept(sizes.select("pair", "block", F.lit(True).alias("hot")), "bk-hot")
    parts = F.transform(
        F.get(F.array(*[F.array(*map(F.lit, ms)) for ms in rest]), F.col("pair")),
        lambda m, i: F.struct(i.alias("sub"), F.col("fp").bitwiseAND(m).alias("part")),
    )
    whole = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("part")))
    rows = rows.join(hot, ["pair", "block"], "left").select("fp", "pair", "block", F.explode(F.when(F.col("hot"), parts).otherwise(whole)).alias("x"))
    rows = rows.select("fp", "pair", "block", "x.sub", "x.part")
    group = ["pair", "block", "sub", "part"]
    sizes = rows.where("sub >= 0").groupBy(*group).agg(F.count("*").alias("size")).where(over)
    large = kept(sizes.select(*group, F.ceil(F.col("size") / shard_size).cast("int").alias("slices")), "bk-large")
    rows = rows.join(large, group, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit("slice"), "fp"), F.col("slices")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return rows.select(
        *group,
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("looks_up"),
        "fp",
    )


def shard_links(radius: int):
    """Task over rows sorted by group that yields the joining links (a, b) of every group."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in in_batches(pair for group in groups(batches) for pair in joining_links(*group, radius)):
            yield pa.RecordBatch.from_arrays([signed_longs(a), signed_longs(b)], ["a", "b"])

    return link


def signed_longs(values: tuple[int, ...]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def in_batches(pairs: Iterable[tuple[int, int]], size: int = 8192) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
    held = []
    for pair in pairs:
        held.append(pair)
        if len(held) == size:
            yield tuple(zip(*held))
            held = []
    if held:
        yield tuple(zip(*held))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int]]]:
    """Values to build the tree of and values to look up, for each group of at least two rows."""
    names = GROUP
    rest = None
    for batch in batches:
        part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*names, "looks_up", "fp")}
        if rest is not None:
            part = {c: np.concatenate([rest[c], v]) for c, v in part.items()}
        n = len(part["fp"])
        cut = np.flatnonzero(np.any([part[c][1:] != part[c][:-1] for c in names], axis=0)) + 1
        edges = np.concatenate([[0], cut])
        yield from cut_groups(part, edges[:-1], edges[1:])
        rest = {c: v[edges[-1] : n] for c, v in part.items()}
    if rest is not None:
        yield from cut_groups(rest, np.array([0]), np.array([len(rest["fp"])]))


def cut_groups(part: dict, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[list[int], list[int]]]:
    prints = part["fp"].view(np.uint64)
    several = ends - starts > 1
    for i, j in zip(starts[several].tolist(), ends[several].tolist()):
        looks_up = part["looks_up"][i:j]
        if part["low"][i] == part["high"][i]:
            yield prints[i:j].tolist(), []
        else:
            yield prints[i:j][~looks_up].tolist(), prints[i:j][looks_up].tolist()


def near_groups(prints: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(fp, root) for each fingerprint of `prints` that has a link; connected ones share a root."""
    dealt = shards(prints, radius, shard_size).repartition(*GROUP).sortWithinPartitions(*GROUP)
    links = dealt.mapInArrow(shard_links(radius), "a long, b long")
    return components(links).toDF("fp", "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Fingerprint and component of each document.

    Gives doc_id, fp (long), component_id (the least doc_id of its component) and root (the component's key).
    """
    marked = kept(docs.select("doc_id", fingerprint(text_or_empty(), shingle).alias("fp")), "simhash")
    prints = kept(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = kept(near_groups(prints.select("fp"), radius, shard_size), "simhash-roots")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ends = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(kept(rooted.select("fp", "root").join(ends, "root"), "simhash-components"), "fp")


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component stays: the one with the least id; of several rows with that id, one."""
    found = kept(near_duplicates(docs, shingle, radius), "simhash-found")
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    several = found.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("doc_id").isNull() | (F.col("n") > 1))
    several = kept(several.select("doc_id"), "simhash-several")
    sure = keep.join(several, "doc_id", "left_anti").select("doc_id")
    rows = docs.select(F.struct("*").alias("row"), "doc_id")
    once = rows.join(kept(sure, "simhash-sure"), "doc_id", "left_semi")
    # rows that share an id, or have none, are told apart by their fingerprint, and one is taken for each component
    same = several.select(F.col("doc_id").alias("kept_id"))
    unsure = rows.join(same, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    unsure = unsure.withColumn("fp", fingerprint(text_or_empty("row.text"), shingle))
    keys = keep.select(F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp"), "root").distinct()
    keys = kept(keys.join(same.toDF("some_id"), F.col("kept_id").eqNullSafe(F.col("some_id")), "left_semi"), "simhash-keys")
    again = unsure.join(keys, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp")))
    return once.select("row.*").unionByName(again.dropDuplicates(["root"]).select("row.*"))


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
