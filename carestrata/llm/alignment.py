"""Cross-tokenizer alignment: where two tokenizers cut the same bytes, and which ids stand for each other.

Both tokenizers give spans with their tokens: character offsets the one, byte spans the other. Places where the spans of
both end are coarse cuts. Between two coarse cuts, the tokens' decoded bytes are added up, which also finds the cuts
inside characters of several bytes and between tokens for single bytes, where spans say nothing. Tokens between two
neighbouring cuts form a group; every first token of a group is linked with every second one.

Texts are cut in front of a space after other text if neither vocabulary can join over it; such chunks are aligned once
and remembered (short ones, at most `REMEMBERED`, then anew). Tokenizers without that property get whole texts.

Counting links: a task numbers its rows in buckets of about `BUCKET` distinct pairs. A bucket's own counts, one row for
each pair in it, are summed to the corpus' counts and joined back by pair; so a pair that stands in every document costs
one row a bucket. Each bucket's documents then meet the bucket's counts, so memory is that of a bucket.

Cases: a null or empty text, and one whose tokens' bytes aren't those of the text behind a space, has no tokens. Repeated
rows are documents of their own; null ids are kept; a text of any length is worked on whole; an empty table gives no rows;
only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table

FIRST, SECOND = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED, SHORT, BUCKET, MANY = 300_000, 64, 1 << 20, 1 << 12
CUT = re.compile(r"(?<=\S)(?= .)", re.S)
#: Bytes that the byte-level alphabet shows as themselves; the others follow from 256 on, in order.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


@dataclass(frozen=True)
class Tokens:
    """Tokens of one text: ids, how many bytes each decodes to, and the places where spans end between characters, as
    bytes, in order, with the number of tokens up to there."""

    ids: np.ndarray
    sizes: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


class Side:
    """A tokenizer: `bytes` has what each id decodes to."""

    bytes: list[bytes]
    cuts_at_spaces: bool

    def sized(self) -> None:
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.names = [str(i) for i in range(len(self.bytes))]

    def spells(self, ids: np.ndarray, whole: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())) == whole


class CharacterSpans(Side):
    """A byte-level tokenizer of the `tokenizers` library, with character offsets."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        hidden = [b for b in range(256) if b not in set(SHOWN)]
        byte_of = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}
        size = self.tokenizer.get_vocab_size()
        self.bytes = [bytes(byte_of[c] for c in self.tokenizer.id_to_token(i)) for i in range(size)]
        made = json.loads(self.tokenizer.to_str())
        how = made.get("pre_tokenizer") or {}
        self.cuts_at_spaces = how.get("type") == "ByteLevel" and how.get("use_regex", True) and not how.get("add_prefix_space") and not made.get("normalizer")
        self.sized()

    def tokens(self, text: str) -> Tokens:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids, offsets = np.array(found.ids, np.int64), np.array(found.offsets, np.int64).reshape(-1, 2)
        # a character split over tokens is in the offsets of each, so that they overlap
        clean = np.append(offsets[1:, 0] >= offsets[:-1, 1], True) if len(ids) else np.zeros(0, bool)
        ends = offsets[clean, 1]
        if not text.isascii():
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            ends = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])[ends]
        return Tokens(ids, self.sizes[ids], ends, np.flatnonzero(clean) + 1)


class ByteSpans(Side):
    """A SentencePiece model, with the byte spans of its proto. It puts a space in front of each text by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.cuts_at_spaces = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.sized()

    def tokens(self, text: str) -> Tokens:
        pieces = self.model.encode(text[1:], return_type="proto").pieces
        ids = np.array([p.id for p in pieces], np.int64)
        # tokens for single bytes have empty spans, but for the last: the first end at a place is the real one
        ends, place = np.unique(np.array([p.end for p in pieces], np.int64) + 1, return_index=True)
        return Tokens(ids, self.sizes[ids], ends, place + 1)


@dataclass(frozen=True)
class Groups:
    """Groups of one text: their ends in bytes, the ids of both tokenizers, and where each group's ids begin in these."""

    ends: np.ndarray
    first: np.ndarray
    first_at: np.ndarray
    second: np.ndarray
    second_at: np.ndarray

    def lists(self) -> list[tuple[int, list[int], list[int]]]:
        a, b = self.first.tolist(), self.second.tolist()
        at = zip(self.ends.tolist(), self.first_at.tolist(), self.first_at[1:].tolist(), self.second_at.tolist(), self.second_at[1:].tolist())
        return [(end, a[i:j], b[k:n]) for end, i, j, k, n in at]


def grouped(a: Tokens, b: Tokens) -> Groups:
    """Groups of two tokenizations that spell the same bytes."""
    our_ends, their_ends = np.cumsum(a.sizes), np.cumsum(b.sizes)
    coarse, i, j = np.intersect1d(a.ends, b.ends, assume_unique=True, return_indices=True)
    i, j = a.counts[i], b.counts[j]
    sure = (our_ends[i - 1] == coarse) & (their_ends[j - 1] == coarse)  # spans never overrule bytes
    coarse, i, j = coarse[sure], i[sure], j[sure]
    if not len(coarse) or coarse[-1] < our_ends[-1]:
        coarse, i, j = np.append(coarse, our_ends[-1]), np.append(i, len(a.ids)), np.append(j, len(b.ids))
    n, m = np.diff(i, prepend=0), np.diff(j, prepend=0)
    open_still = (n > 1) & (m > 1)
    # what several tokens of both cover may hold further cuts, which only their bytes show
    fine = np.intersect1d(our_ends[np.repeat(open_still, n)], their_ends[np.repeat(open_still, m)], assume_unique=True)
    ends = np.union1d(coarse, fine)
    return Groups(ends, a.ids, heads(our_ends, ends), b.ids, heads(their_ends, ends))


def heads(token_ends: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the tokens of each group begin, and where the last one's end."""
    return np.append(0, np.searchsorted(token_ends, ends) + 1)


def links(g: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked ids (the first one in the upper 32 bits), how often, and in which group; a pair may come several times."""
    n, m = np.diff(g.first_at), np.diff(g.second_at)
    many = n * m > MANY
    group = np.repeat(np.arange(len(n)), n)
    own = ~many[group]
    ours, group = g.first[own], group[own]
    each = m[group]
    begin = np.cumsum(each) - each
    place = np.repeat(g.second_at[group] - begin, each) + np.arange(each.sum())
    pairs, times, groups = [np.repeat(ours, each) << 32 | g.second[place]], [np.ones(len(place), np.int64)], [np.repeat(group, each)]
    for k in np.flatnonzero(many).tolist():  # a long stretch without a common cut: each pair of its distinct ids once
        a, a_times = np.unique(g.first[g.first_at[k] : g.first_at[k + 1]], return_counts=True)
        b, b_times = np.unique(g.second[g.second_at[k] : g.second_at[k + 1]], return_counts=True)
        pairs.append((a[:, None] << 32 | b).ravel())
        times.append((a_times[:, None] * b_times).ravel())
        groups.append(np.full(len(a) * len(b), k))
    return np.concatenate(pairs), np.concatenate(times), np.concatenate(groups)


def written(g: Groups, first_names: list[str], second_names: list[str]) -> tuple[str, np.ndarray]:
    """`a1,a2|b1;a3|b2;`, and where in it each group begins."""
    n, m = np.diff(g.first_at), np.diff(g.second_at)
    at = np.arange(n.sum() + m.sum())
    group = np.repeat(np.arange(len(n)), n + m)
    within = at - (g.first_at + g.second_at)[group]
    ours = within < n[group]
    marks = np.where(within == n[group] - 1, 1, np.where(within == (n + m)[group] - 1, 2, 0))
    ids = np.empty(len(at), np.int64)
    ids[ours], ids[~ours] = g.first, g.second
    parts = [""] * (2 * len(at))
    parts[1::2] = map(",|;".__getitem__, marks.tolist())
    parts[0::2] = [first_names[i] if o else second_names[i] for i, o in zip(ids.tolist(), ours.tolist())]
    sizes = np.cumsum(np.log10(np.maximum(ids, 1)).astype(np.int64) + 2)
    return "".join(parts), np.append(0, sizes[g.first_at[1:] + g.second_at[1:] - 1])


class Pool:
    """A growing array of whole numbers."""

    def __init__(self) -> None:
        self.room, self.size = np.zeros(1024, np.int64), 0

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.room):
            self.room = np.concatenate([self.room[: self.size], np.zeros(end, np.int64)])
        self.room[self.size : end] = values
        self.size = end

    def all(self) -> np.ndarray:
        return self.room[: self.size]


class Chunks(dict):
    """Number of each chunk met; what is known of chunk i is at i in `sums` and `texts`, its pairs from `begins[i]` on."""

    def __init__(self, first: CharacterSpans, second: ByteSpans) -> None:
        self.first, self.second = first, second
        self.cuts = first.cuts_at_spaces and second.cuts_at_spaces
        self.forget(np.zeros(0, np.int64))

    def forget(self, but: np.ndarray) -> None:
        """Forget all chunks but those of these numbers."""
        keys, old = list(self), self.texts if but.size else []
        sums, begins, pairs, times = (p.all() for p in (self.sums, self.begins, self.pairs, self.times)) if but.size else ([],) * 4
        self.clear()
        self.texts: list[str] = []
        self.sums, self.begins, self.pairs, self.times, self.uses = Pool(), Pool(), Pool(), Pool(), Pool()
        self.begins.add(np.zeros(1, np.int64))
        if but.size:
            for n, i in enumerate(but.tolist()):
                self[keys[i]] = n
                self.texts.append(old[i])
            place, size = spread(begins, but)
            self.sums.add(sums.reshape(-1, 4)[but].ravel())
            self.begins.add(np.cumsum(size))
            self.pairs.add(pairs[place])
            self.times.add(times[place])
            self.uses.add(np.zeros(len(but), np.int64))

    def drop(self, n: int) -> None:
        """Forget all but the first n chunks."""
        while len(self) > n:
            self.popitem()
        del self.texts[n:]
        self.sums.size, self.begins.size, self.uses.size = 4 * n, n + 1, n
        self.pairs.size = self.times.size = int(self.begins.room[n])

    def parts(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def spelt(self, text: str) -> Groups | None:
        """Groups of one text that begins with a space; None if the tokens of either don't spell it."""
        whole = text.encode()
        a, b = self.first.tokens(text), self.second.tokens(text)
        return grouped(a, b) if self.first.spells(a.ids, whole) and self.second.spells(b.ids, whole) else None

    def learn(self, chunks: list[str]) -> None:
        """Chunks are run together and aligned as one text, as nothing joins over their bounds; if its bytes differ, by halves."""
        if not chunks:
            return
        g = self.spelt("".join(chunks))
        if g is None and len(chunks) > 1:
            self.learn(chunks[: len(chunks) // 2])
            self.learn(chunks[len(chunks) // 2 :])
            return
        self.update(zip(chunks, range(len(self), len(self) + len(chunks))))
        self.uses.add(np.zeros(len(chunks), np.int64))
        if g is None:
            self.texts.append("")
            self.sums.add(np.array([-1, 0, 0, 0]))
            self.begins.add(self.begins.all()[-1:].copy())
            return
        size = np.array([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        to = np.searchsorted(g.ends, np.cumsum(size)) + 1  # number of groups up to each chunk's end
        text, at = written(g, self.first.names, self.second.names)
        cut = np.append(0, at[to]).tolist()
        self.texts += [text[i : j - 1] for i, j in zip(cut, cut[1:])]
        pairs, times, group = links(g)
        owner = np.searchsorted(to, group, "right")
        order = np.lexsort((pairs, owner))
        pairs, times, owner = pairs[order], times[order], owner[order]
        fresh = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])))
        times, pairs, owner = np.add.reduceat(times, fresh), pairs[fresh], owner[fresh]
        n_links = np.bincount(owner, weights=times, minlength=len(chunks)).astype(np.int64)
        sums = [np.diff(x, prepend=0) for x in (g.first_at[to], g.second_at[to], to)]
        self.sums.add(np.stack([*sums, n_links], axis=1).ravel())
        self.begins.add(self.pairs.size + np.searchsorted(owner, np.arange(len(chunks)), "right"))
        self.pairs.add(pairs)
        self.times.add(times)

    def numbers(self, texts: list[str]) -> tuple[list[list[int]], int]:
        """Chunk numbers of each text, and how many chunks are worth keeping afterwards."""
        if len(self) > REMEMBERED:
            often = np.flatnonzero(self.uses.all() > 2)
            self.forget(often if len(often) <= REMEMBERED // 2 else often[:0])
        cut = [self.parts(t) if t else [] for t in texts]
        new = list(dict.fromkeys(c for parts in cut for c in parts if c not in self))
        # one that ends in white space can't be followed by another
        joint = [c for c in new if len(c) <= SHORT and self.cuts and not c[-1].isspace()]
        for i in range(0, len(joint), 4096):
            self.learn(joint[i : i + 4096])
        short = len(self)
        for c in new:
            if c not in self:
                self.learn([c])
        return [list(map(self.__getitem__, parts)) for parts in cut], short


def spread(begins: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of these runs, one run after the other, and the runs' sizes; run i is from begins[i] on."""
    size = begins[which + 1] - begins[which]
    return np.repeat(begins[which] - (np.cumsum(size) - size), size) + np.arange(size.sum()), size


@lru_cache(maxsize=2)
def chunks_of(first: str, second: str) -> Chunks:
    return Chunks(CharacterSpans(first), ByteSpans(second))


def groups_of(text: str | None, chunks: Chunks) -> list[tuple[int, list[int], list[int]]]:
    """Groups of a whole text behind a space: end in bytes, ids of either; none if the bytes differ."""
    found = chunks.spelt(" " + text) if text else None
    return [] if found is None else found.lists()


def alignments(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """`docs` with `groups`: end of each group in bytes of the text behind a space, and the ids of both tokenizers."""

    @F.arrow_udf("array<struct<end:long,first:array<int>,second:array<int>>>")
    def found(texts: pa.Array) -> pa.Array:
        chunks = chunks_of(first, second)
        rows = [[{"end": e, "first": a, "second": b} for e, a, b in groups_of(t, chunks)] for t in texts.to_pylist()]
        ids = pa.list_(pa.int32())
        return pa.array(rows, pa.list_(pa.struct([("end", pa.int64()), ("first", ids), ("second", ids)])))

    return docs.select(*[F.col(c) for c in docs.columns if c != "groups"], found(F.col("text").cast("string")).alias("groups"))


SUMS = ["n_a", "n_b", "n_groups", "n_links"]
TALLIED = "bucket long, whole boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
RATED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def tallied(batches: Iterator[pa.RecordBatch], first: str, second: str) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text): a row for each document, its distinct pairs and their numbers; and, with `whole`, a row for
    each bucket, with the number of its documents that hold each pair."""
    chunks, form = chunks_of(first, second), schema(TALLIED)
    bucket, size, held = TaskContext.get().partitionId() << 24, 0, []

    def closed() -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        none = [pa.array([None], form.field(k).type) for k in range(2, 8)]
        ends = np.array([0, len(pairs)])
        return pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([True]), *none, lists(ends, pairs), lists(ends, n)], schema=form)

    for batch in batches:
        for begun in range(0, batch.num_rows, 256):
            part = batch.slice(begun, 256)
            texts = part.column(1).to_pylist()
            numbers, keep = chunks.numbers([t or "" for t in texts])
            counts = np.array([len(x) for x in numbers])
            flat = np.fromiter((x for row in numbers for x in row), np.int64, counts.sum())
            owner = np.repeat(np.arange(len(texts)), counts)
            chunks.uses.room[: chunks.uses.size] += np.bincount(flat, minlength=chunks.uses.size)
            sizes = chunks.sums.all().reshape(-1, 4)[flat]
            bad = np.zeros(len(texts), bool)
            bad[owner[sizes[:, 0] < 0]] = True
            sums = np.zeros((len(texts), 4), np.int64)
            np.add.at(sums, owner, sizes)
            sums[bad] = 0
            digests = [
                hashlib.sha256(";".join(map(chunks.texts.__getitem__, x)).encode()).hexdigest() if x and not b else ""
                for x, b in zip(numbers, bad.tolist())
            ]
            # pairs of all chunks of all good texts, with the row they belong to
            used = ~bad[owner]
            source, n = spread(chunks.begins.all(), flat[used])
            pairs, times, rows = chunks.pairs.all()[source], chunks.times.all()[source], np.repeat(owner[used], n)
            order = np.lexsort((pairs, rows))
            pairs, times, rows = pairs[order], times[order], rows[order]
            fresh = np.ones(len(pairs), bool)
            fresh[1:] = (pairs[1:] != pairs[:-1]) | (rows[1:] != rows[:-1])
            starts = np.flatnonzero(fresh)
            times = np.add.reduceat(times, starts) if len(starts) else times
            pairs, rows = pairs[starts], rows[starts]
            offsets = np.searchsorted(rows, np.arange(len(texts) + 1))
            columns = [np.full(len(texts), bucket), np.zeros(len(texts), bool)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), part.column(0), *(pa.array(sums[:, k]) for k in range(4)), pa.array(digests, pa.string()), lists(offsets, pairs), lists(offsets, times)],
                schema=form,
            )
            held.append(pairs)
            size += len(pairs)
            chunks.drop(keep)
            if size >= BUCKET:
                yield closed()
                bucket, size, held = bucket + 1, 0, []
    if held:
        yield closed()


def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over a bucket's counts and then its documents, bucket by bucket: each document's sums over its links."""
    known: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.zeros(0, np.int64),) * 3
    form = schema(RATED)

    def sums(rows: pa.RecordBatch) -> pa.RecordBatch:
        pairs, times = (rows.column(name).flatten().to_numpy() for name in ("pairs", "times"))
        size = np.diff(np.asarray(rows.column("pairs").offsets))
        owner = np.repeat(np.arange(rows.num_rows), size)
        place = np.searchsorted(known[0], pairs)
        best, total = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        if len(pairs):
            np.add.at(best, owner, times * known[2][place])
            np.add.at(total, owner, times * known[1][place])
        made = {name: rows.column(name) for name in ("doc_id", *SUMS, "groups_sha256")} | {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.RecordBatch.from_arrays([made[f.name] for f in form], schema=form)

    for batch in batches:
        heads = np.flatnonzero(batch.column("whole").to_numpy(zero_copy_only=False)).tolist()
        for at, end in zip([-1, *heads], [*heads, batch.num_rows]):
            if at >= 0:
                row = batch.slice(at, 1)
                pairs, n, best = (row.column(name).flatten().to_numpy() for name in ("pairs", "times", "best"))
                order = np.argsort(pairs)
                known = pairs[order], n[order], best[order]
            if end > at + 1:
                yield sums(batch.slice(at + 1, end - at - 1))


def link_counts(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """One row a document, see `RATED`: tokens, groups and links, and how they stand in the whole corpus.

    A pair's count is the number of documents that hold it linked; `n_best` counts the links whose pair no other pair of
    the same first id exceeds, `count_sum` adds up the counts over all links.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tally = kept(rows.mapInArrow(lambda batches: tallied(batches, first, second), TALLIED), "aligned")
    entry = F.explode(F.arrays_zip("pairs", "times")).alias("x")
    local = tally.where("whole").select("bucket", entry).select("bucket", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    counts = local.groupBy("pair").agg(F.sum("n").alias("n"))
    best = F.col("n") == F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    counts = kept(counts.select("pair", "n", best.cast("long").alias("best")), "pair-counts")
    known = local.select("bucket", "pair").join(counts, "pair").groupBy("bucket").agg(F.collect_list(F.struct("pair", "n", "best")).alias("known"))
    none = F.array().cast("array<long>")
    heads = known.select(
        "bucket",
        F.lit(True).alias("whole"),
        *[F.lit(None).cast("long").alias(c) for c in ("doc_id", *SUMS)],
        F.lit(None).cast("string").alias("groups_sha256"),
        F.col("known.pair").alias("pairs"),
        F.col("known.n").alias("times"),
        F.col("known.best").alias("best"),
    )
    both = tally.where("NOT whole").withColumn("best", none).unionByName(heads)
    return both.repartition("bucket").sortWithinPartitions("bucket", F.desc("whole")).mapInArrow(rated, RATED)


def op13_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return link_counts(table(spark, sf_dir, "documents"))
