"""Upsert of a batch into a current-state table, changing only rows whose content differs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.functions.hashing import row_text
from carestrata.settings import META_SCHEMA

BROADCAST_LIMIT = 64 * 1024 * 1024


@dataclass(frozen=True)
class BatchStamp:
    """Who loads and when. Literals, so a re-run of the batch writes the same rows."""

    program: str
    subject: str
    batch_id: int
    as_of: datetime

    def columns(self) -> dict[str, Column]:
        values = (self.program, self.subject, self.batch_id, self.as_of, None, None)
        return {f.name: F.lit(v).cast(f.dataType) for f, v in zip(META_SCHEMA, values, strict=True)}

    def put_on(self, df: DataFrame) -> DataFrame:
        """The six batch columns first, then the data columns."""
        stamped = self.columns()
        data = [c for c in df.columns if c not in stamped]
        return df.select(*[v.alias(k) for k, v in stamped.items()], *data)

    def put_on_with_id(self, df: DataFrame) -> DataFrame:
        """As `put_on`, with a row id that is unique within the batch."""
        return self.put_on(df).withColumn("META_ROW_ID", F.monotonically_increasing_id())

    def fill_in(self, df: DataFrame) -> DataFrame:
        """Stamp only rows that carry no batch yet."""
        fresh = F.col("META_BATCH_ID").isNull()
        return df.withColumns({k: F.when(fresh, v).otherwise(F.col(k)) for k, v in self.columns().items()})


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def reject_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail as soon as a key occurs twice. Partitions and sorts by the key, which the following join reuses."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(F.lit("merge source holds a key twice: "), F.to_json(F.struct(*keys)))
    ok = F.when(F.col("_nth") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.withColumn("_nth", nth).where(ok).drop("_nth")


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[k] == right[f"s_{k}"] for k in keys])


def differs(business: Sequence[str], sep: str = "") -> Column:
    """Content of gold (`c`) against source (`s_c`). Comparing the hashed text says the same as comparing its
    digests, without computing two digests per row."""
    return row_text(business, sep) != row_text([f"s_{c}" for c in business], sep)


def merge_changed(
    gold: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    business: Sequence[str],
    stamp: BatchStamp,
    sep: str = "",
    null_keys: str = "insert",
    strategy: str = "shuffle",
) -> DataFrame:
    """Next state of `gold`: unmatched source rows inserted, matched rows whose content differs updated, rest kept.

    strategy "shuffle": one full outer join; with gold bucketed by its keys only the batch is exchanged.
    strategy "broadcast": gold is never exchanged; a batch whose measured size is over the limit (see `fits_broadcast`)
    is merged as by "shuffle".
    NULL keys match nothing. They are kept out of the join, where they would all meet in one task, and are
    inserted (or dropped with null_keys="drop"). Sources that filter them anyway say null_keys="absent", which
    saves the extra read of gold for them.
    """
    if null_keys not in ("insert", "drop", "absent"):
        raise ValueError("null_keys is 'insert', 'drop' or 'absent'")
    meta = stamp.columns()
    columns = [*meta, *keys, *business]
    keyed = F.lit(True) if null_keys == "absent" else ~any_null(keys)
    rows = source.select(*keys, *business)
    src = reject_repeats(rows.where(keyed), keys)
    src = src.select(*[F.col(c).alias(f"s_{c}") for c in (*keys, *business)], F.lit(True).alias("s_row"))
    old = gold.select(*columns).where(keyed).withColumn("g_row", F.lit(True))

    if strategy == "broadcast" and not fits_broadcast(rows, [*keys, *business]):
        strategy = "shuffle"
    if strategy == "shuffle":
        joined = old.join(src, _match(old, src, keys), "full_outer")
        merged = _next_state(joined, meta, keys, business, sep)
    elif strategy == "broadcast":
        small = F.broadcast(src)
        touched = old.join(small, _match(old, small, keys), "left")
        known = old.select(*keys).join(small, _match(old, small, keys), "left_semi")
        fresh = src.join(known, _match(known, src, keys), "left_anti")
        inserts = fresh.select(*[v.alias(k) for k, v in meta.items()], *[F.col(f"s_{c}").alias(c) for c in (*keys, *business)])
        merged = _next_state(touched, meta, keys, business, sep).unionByName(inserts)
    else:
        raise ValueError(f"unknown merge strategy {strategy!r}")

    if null_keys != "absent":
        merged = merged.unionByName(gold.select(*columns).where(any_null(keys)))
    if null_keys == "insert":
        merged = merged.unionByName(stamp.put_on(rows.where(any_null(keys))))
    return merged


def _next_state(joined: DataFrame, meta: dict[str, Column], keys: Sequence[str], business: Sequence[str], sep: str) -> DataFrame:
    """Rows after the merge. The comparison is a column of its own, so it is computed once per row."""
    changed = F.col("s_row") & differs(business, sep)
    decided = joined.withColumn("_next", F.when(F.col("g_row").isNull(), "insert").when(changed, "update"))
    inserted, updated = F.col("_next") == "insert", F.col("_next") == "update"
    kept = {
        "META_DATE_UPDATE": F.when(updated, meta["META_DATE_INSERT"]).otherwise(F.col("META_DATE_UPDATE")),
        "META_UPD_BATCH_ID": F.when(updated, meta["META_BATCH_ID"]).otherwise(F.col("META_UPD_BATCH_ID")),
    }
    out = [F.when(inserted, new).otherwise(kept.get(name, F.col(name))).alias(name) for name, new in meta.items()]
    out += [F.coalesce(F.col(k), F.col(f"s_{k}")).alias(k) for k in keys]
    out += [F.when(F.col("_next").isNotNull(), F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in business]
    return decided.select(*out)


def fits_broadcast(source: DataFrame, columns: Sequence[str], limit: int = BROADCAST_LIMIT) -> bool:
    """Measure the batch: text bytes plus a per-row allowance must stay under the limit."""
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in columns])
    size = source.select(F.sum(width.cast("bigint")).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit


def merge_counts(merged: DataFrame, batch_id: int) -> DataFrame:
    """Outcome of a merge, read back from two narrow columns of the merged state."""
    upd, ins = F.col("META_UPD_BATCH_ID"), F.col("META_BATCH_ID")
    inserted = F.coalesce(ins == batch_id, F.lit(False)) & F.coalesce(upd != batch_id, F.lit(True))
    return merged.agg(
        F.count_if(inserted).alias("inserted"),
        F.count_if(upd == batch_id).alias("updated"),
        F.count(F.lit(1)).alias("gold_total"),
    )
