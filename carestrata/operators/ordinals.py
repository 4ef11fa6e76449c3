"""Gap-free row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 100_000
SAMPLES_PER_RANGE = 64
MOST_RANGES = 4096


def cut_points(df: DataFrame, order_by: str, rows_per_range: int = ROWS_PER_RANGE) -> list[str]:
    """Values that cut the order into ranges of about equal size, one for each `rows_per_range` rows.

    They are the quantiles of the values with the smallest hashes, a fixed random sample of many values a range.
    """
    ranges = min(MOST_RANGES, max(1, -(-df.count() // rows_per_range)))
    if ranges == 1:
        return []
    sample = df.select(order_by).where(F.col(order_by).isNotNull()).orderBy(F.xxhash64(order_by), order_by)
    values = sorted(r[0] for r in sample.limit(ranges * SAMPLES_PER_RANGE).collect())
    return sorted({values[len(values) * i // ranges] for i in range(1, ranges)})


def number_rows(df: DataFrame, order_by: str, out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """1..n in the order of a unique text column.

    A row's number is its rank in its range plus the sizes of the ranges before it; only these sizes, one row per
    range, meet in one task.
    """
    cuts = cut_points(df, order_by, rows_per_range)
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<string>")
    ranged = df.withColumn("_range", F.size(F.filter(bounds, lambda c: c <= F.col(order_by))))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(order_by))
    # `offsets` has at most MOST_RANGES rows
    return (
        ranged.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, (F.col("_before") + F.col("_rank")).cast("bigint"))
        .drop("_range", "_rank", "_before")
    )
