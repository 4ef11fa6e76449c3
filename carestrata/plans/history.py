"""Stored history (type 2): batches may come in any order of their days, and may come again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.cleanse import OPEN_END_DATE
from carestrata.operators.history import CONFIRMED, VALIDITY, placed, rebuilt, split_current
from carestrata.operators.merge import BatchStamp, any_null
from carestrata.plans.tables import DEFAULT_BUCKETS, GoldTable, Head, commit, delete
from carestrata.settings import TargetTable


class StoredHistory:
    """Current and closed versions, each a table of buckets; one commit makes a batch current in both.

    A batch tells the content of its keys on its day (ISO text). The versions are those that all batches give when taken
    by day, whatever order they came in: each version notes the days that confirmed it, so a late batch can split it
    where it has to be split. A batch in time meets current versions only, in the buckets that it hits; closed versions
    are read for keys with late news alone. Of two batches for one day the one taken last holds, for the keys it has.
    NULL and '' are two contents. Rows with a NULL key have no history; they are counted. `META_BATCH_ID` is the batch
    that wrote a version last.
    """

    def __init__(self, spark: SparkSession, root: str, target: TargetTable, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.root, self.keys, self.business = spark, root, target.keys, target.business
        columns = (*target.business, *VALIDITY, CONFIRMED)
        self.current = GoldTable(spark, root, TargetTable(f"{target.name}_CURRENT", target.keys, columns), buckets)
        self.closed = GoldTable(spark, root, TargetTable(f"{target.name}_CLOSED", target.keys, columns), buckets)

    def versions(self) -> DataFrame:
        return self.current.current().unionByName(self.closed.current())

    def on(self, day: str) -> DataFrame:
        """Content of each key on a day."""
        return self.versions().where((F.col("VALID_FROM") <= day) & (F.col("VALID_TO") > day))

    def take(self, batch: DataFrame, day: str, stamp: BatchStamp) -> dict:
        """Merge what a batch tells of its day, and make it current."""
        heads, counts = self.staged(batch, day, stamp)
        commit(self.spark, self.root, heads, stamp.batch_id, stamp.as_of)
        return counts

    def staged(self, batch: DataFrame, day: str, stamp: BatchStamp) -> tuple[dict[str, Head], dict]:
        """Merge a batch into versions of both tables that are not current yet, and count what it did."""
        if not day < OPEN_END_DATE:
            raise ValueError(f"{day} is not before {OPEN_END_DATE}")
        keys, business = self.keys, self.business
        work = f"{self.root}/_work/{self.current.target.name}/batch={stamp.batch_id}"
        rows = self._written(batch.select(*[F.col(c).cast("string").alias(c) for c in (*keys, *business)]), f"{work}/told")
        keyless = F.count_if(any_null(keys))
        seen = rows.agg(F.count(F.lit(1)).alias("rows"), keyless.alias("keyless")).first().asDict()
        rows = rows.where(~any_null(keys))
        base, past = self.current.head(), self.closed.head()
        touched = self.current.touched(rows, base)
        if not touched:
            delete(self.spark, work)
            return {}, seen | {"late": 0, "closed": 0}

        spread = rows.repartition(base.buckets, *keys)
        met = self._written(placed(self.current.at(base, touched), spread, keys, business, day), f"{work}/met")
        late = met.where("late")
        hit = self.closed.touched(late, past)
        known = self.closed.at(past, hit)
        fresh = split_current(met, keys, business, day).unionByName(rebuilt(met, known, keys, business, day))
        fresh = self._written(stamp.put_on(fresh), f"{work}/fresh")

        ended = fresh.where("IS_CURRENT = 'N'")
        heads = {self.current.target.name: self._staged(self.current, base, touched, rows, fresh.where("IS_CURRENT = 'Y'"))}
        changed = sorted({*hit, *self.closed.touched(ended, past)})
        if changed:
            heads[self.closed.target.name] = self._staged(self.closed, past, changed, late, ended)
        counts = seen | {"late": late.count(), "closed": ended.count()}
        delete(self.spark, work)
        return heads, counts

    def _staged(self, part: GoldTable, base: Head, touched: list[int], gone: DataFrame, new: DataFrame) -> Head:
        """The touched buckets of a table without the keys of `gone`, with the rows of `new`. Both are partitioned as the
        buckets are, so what the table has is neither exchanged for the join nor for the union."""
        keys, columns = list(self.keys), part.target.columns
        left = part.at(base, touched).join(gone.select(*keys).repartition(base.buckets, *keys), keys, "left_anti")
        rows = left.select(*columns).unionByName(new.select(*columns).repartition(base.buckets, *keys))
        return part.stage(rows, base, touched)

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        """Written once, for steps that are read again; as much as the batch and the versions of its keys."""
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
