"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Training reads a bounded sample of labelled rows, dealt over a fixed number of shards. Each shard is streamed through
one task that updates its weights text by text; the shards' weights are averaged. Scoring is a sparse dot product of
whole texts with the weights, which have at most 2**`bits` + 1 entries and so may be broadcast.

Cases: a null or empty text has no features and gets the score of the bias; a null id or label is never trained on, nor
an id with labels that differ; repeated rows are scored alike; a text of any length is scored whole; no training row gives
weights of zero, so all scores are one half; an empty table gives no rows; other columns stay, whatever their names, but
for `score` and `predicted`, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.arrays import byte_classes, chunks, flat, grams, lower_bytes, mixed, per_text, tokens
from carestrata.llm.store import table, text_or_empty

KINDS, FOLD = byte_classes(), lower_bytes()


@dataclass(frozen=True)
class Ftrl:
    """`sample` bounds the labelled rows read; the shards share them, `epochs` passes over each."""

    bits: int = 18
    ngrams: int = 2
    scale: float = 30.0
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    sample: int = 16_384
    shards: int = 4
    epochs: int = 2


def held_out(doc_id: Column) -> Column:
    """Rows kept back from training; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(texts: pa.Array, p: Ftrl) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: number of the first, hashed places, place of each text's first entry, texts' entry counts.

    Beside the words and their n-grams, each token adds one abstract gram that says whether it repeats the token before
    it or the one before that: repetition has no words of its own to learn.
    """
    mask = np.uint64((1 << p.bits) - 1)
    raw, at = flat(texts)
    for i, _, data, places in chunks(raw, at):
        found = tokens(data, places, KINDS, FOLD)
        parts = [found.hash, mixed(np.uint64(0x5EED) + repeats(found.hash, found.first))]
        owner = [np.arange(len(found.hash))] * 2
        for k in range(2, p.ngrams + 1):
            h, place = grams(found.hash, found.first, k)
            parts.append(h)
            owner.append(place)
        where = np.concatenate(owner)
        order = np.argsort(where, kind="stable")
        slot = (np.concatenate(parts)[order] & mask).astype(np.int64)
        first = np.searchsorted(where[order], found.first)
        yield i, slot, first, np.diff(first)


def repeats(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1 where a token equals the one before, plus 2 where it equals the one two before, in the same text."""
    out = np.zeros(len(h), np.uint64)
    number = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    for back, bit in ((1, 1), (2, 2)):
        out[back:] += np.uint64(bit) * ((h[back:] == h[:-back]) & (number[back:] >= back)).astype(np.uint64)
    return out


def trainer(p: Ftrl):
    """Task that streams (label, text) rows of one shard in the given order and returns its weights."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << p.bits) + 1  # the last is the bias
        z, n, seen = np.zeros(size), np.zeros(size), 0
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for i, slot, first, counts in features(batch.column("text"), p):
                for j in range(len(counts)):
                    at, times = np.unique(slot[first[j] : first[j + 1]], return_counts=True)
                    at = np.append(at, size - 1)
                    x = np.append(p.scale * times / max(1, counts[j]), 1.0)
                    zi, ni = z[at], n[at]
                    w = weights(zi, ni, p)
                    w[-1] = -zi[-1] / ((p.beta + np.sqrt(ni[-1])) / p.alpha)  # the bias isn't shrunk
                    g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i + j]) * x
                    z[at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / p.alpha * w
                    n[at] += g * g
                    seen += 1
        if seen:
            w = weights(z, n, p)
            w[-1] = -z[-1] / ((p.beta + np.sqrt(n[-1])) / p.alpha)
            at = np.append(np.flatnonzero(w[:-1]), size - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["slot", "w"])

    return train


def weights(z: np.ndarray, n: np.ndarray, p: Ftrl) -> np.ndarray:
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def fit(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> np.ndarray:
    """Weights from at most `p.sample` labelled ids, the ones whose hashes are least.

    An id with labels that differ isn't learnt from; of several texts with one id, the least is. So a fit is the same
    each time.
    """
    order = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("label"), F.max("quality").cast("double").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
        .orderBy(order)
        .limit(p.sample)
    )
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    turns = (
        rows.withColumn("epoch", F.explode(F.array(*[F.lit(i) for i in range(p.epochs)])))
        .repartition(p.shards, F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(p.shards)))
        .sortWithinPartitions("epoch", F.xxhash64("epoch", "doc_id"), F.xxhash64("text"))
        .select("label", "text")
    )
    parts = turns.mapInArrow(trainer(p), "slot long, w double").groupBy("slot").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    # added in order: a sum of doubles in the order of arrival would differ from run to run
    parts = parts.select("slot", F.aggregate("ws", F.lit(0.0), lambda a, x: a + x).alias("w"), F.size("ws").alias("n"))
    found = parts.toPandas()
    out = np.zeros((1 << p.bits) + 1)
    if len(found):
        out[found["slot"].to_numpy()] = found["w"].to_numpy() / found["n"].max()
    return out


def score(docs: DataFrame, w: np.ndarray, p: Ftrl = Ftrl(), name: str = "score") -> DataFrame:
    """Add the score of each whole text, between 0 and 1."""
    sent = docs.sparkSession.sparkContext.broadcast(w.astype(np.float32))

    @F.arrow_udf("double")
    def dot(texts: pa.Array) -> pa.Array:
        model = sent.value
        out = np.empty(len(texts))
        for i, slot, first, counts in features(texts, p):
            sums = per_text(model[slot].astype(np.float64), first)
            out[i : i + len(counts)] = p.scale * sums / np.maximum(1, counts) + model[-1]
        return pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return docs.withColumn(name, dot(text_or_empty()))


ACCEPT = 0.7


def judge(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """`docs` with `score` and `predicted` (1 from a score of 0.7 up)."""
    scored = score(docs, fit(docs, labels, p), p)
    return scored.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
