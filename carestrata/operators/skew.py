"""Joins that stay even when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    many: DataFrame, one: DataFrame, keys: Sequence[str], spread: Column, how: str = "inner", salts: int = 16
) -> DataFrame:
    """Join a fact side with a side that is unique per key.

    Every key's rows are dealt over `salts` tasks by `spread`; the unique side is repeated once per salt.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    right = one.withColumn("_salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)])))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
