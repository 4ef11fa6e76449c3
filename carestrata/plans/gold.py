"""Silver batch into gold."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carestrata.operators.merge import BatchStamp, merge_changed, merge_counts
from carestrata.plans.tables import GoldTable, Head, commit


def staged_upsert(gold: GoldTable, silver: DataFrame, stamp: BatchStamp, sep: str = "", null_keys: str = "absent") -> tuple[Head, dict]:
    """Merge one silver batch into a version that is not current yet, and count what it did.

    Gold is bucketed by its keys. Only the buckets that the batch's keys fall into are read and written. The batch is
    exchanged once into as many partitions as gold has buckets, gold not at all, and each task of the full outer join
    writes one bucket. The total comes from the manifest.
    """
    target, head = gold.target, gold.head()
    touched = gold.touched(silver, head)
    batch = silver.repartition(head.buckets, *target.keys)
    merged = merge_changed(gold.at(head, touched), batch, target.keys, target.business, stamp, sep=sep, null_keys=null_keys)
    staged = gold.stage(merged, head, touched)
    counts = merge_counts(gold.at(staged, touched), stamp.batch_id).first().asDict()
    return staged, counts | {"gold_total": sum(r["rows"] for r in gold.manifest(staged))}


def upsert(gold: GoldTable, silver: DataFrame, stamp: BatchStamp, sep: str = "", null_keys: str = "absent") -> dict:
    """Merge one silver batch and publish the result."""
    staged, counts = staged_upsert(gold, silver, stamp, sep, null_keys)
    commit(gold.spark, gold.root, {gold.target.name: staged}, stamp.batch_id, stamp.as_of)
    return counts
