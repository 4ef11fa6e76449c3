"""Slowly changing history (type 2): every version of a row, with the days it was valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.functions.cleanse import OPEN_END_DATE
from carestrata.operators.merge import any_null, differs, reject_repeats

VALIDITY = ("VALID_FROM", "VALID_TO", "IS_CURRENT")
CONFIRMED = "CONFIRMED_DAYS"  # days of the batches that brought a version's content, comma-joined, ascending


def track_history(
    history: DataFrame, batch: DataFrame, keys: Sequence[str], business: Sequence[str], day: str, sep: str = "|"
) -> DataFrame:
    """Next history: a changed row closes its current version at `day` and opens a new one; new keys open one.

    Only current versions join the batch; closed ones pass through without an exchange. Rows with a NULL key
    match nothing and open a version of their own.
    """
    columns = [*keys, *business, *VALIDITY]
    rows = batch.select(*keys, *business)
    src = reject_repeats(rows.where(~any_null(keys)), keys)
    src = src.select(*[F.col(c).alias(f"s_{c}") for c in (*keys, *business)], F.lit(True).alias("s_row"))

    live = (F.col("IS_CURRENT") == "Y") & ~any_null(keys)
    current = history.select(*columns).where(live).withColumn("h_row", F.lit(True))
    on = [current[k] == src[f"s_{k}"] for k in keys]
    compared = F.coalesce(F.col("h_row") & F.col("s_row") & differs(business, sep), F.lit(False))
    joined = current.join(src, on, "full_outer").withColumn("_changed", compared)
    changed = F.col("_changed")
    closed = F.struct(
        *[F.col(c) for c in (*keys, *business)],
        F.col("VALID_FROM"),
        F.when(changed, F.lit(day)).otherwise(F.col("VALID_TO")).alias("VALID_TO"),
        F.when(changed, "N").otherwise(F.col("IS_CURRENT")).alias("IS_CURRENT"),
    )
    opened = F.struct(
        *[F.col(f"s_{c}").alias(c) for c in (*keys, *business)],
        F.lit(day).alias("VALID_FROM"),
        F.lit(OPEN_END_DATE).alias("VALID_TO"),
        F.lit("Y").alias("IS_CURRENT"),
    )
    versions = (
        F.when(F.col("h_row").isNull(), F.array(opened))
        .when(changed, F.array(closed, opened))
        .otherwise(F.array(closed))
    )
    moved = joined.select(F.inline(versions))
    keyless = rows.where(any_null(keys)).select(
        *keys, *business, F.lit(day).alias("VALID_FROM"), F.lit(OPEN_END_DATE).alias("VALID_TO"), F.lit("Y").alias("IS_CURRENT")
    )
    return moved.unionByName(history.select(*columns).where(~F.coalesce(live, F.lit(False)))).unionByName(keyless)


def placed(current: DataFrame, batch: DataFrame, keys: Sequence[str], business: Sequence[str], day: str) -> DataFrame:
    """Batch rows (`s_` columns) beside the current version of their key (`was`, NULL for a new key).

    `late` rows say something about a day that the current version does not decide alone: a day before it began, or
    other content for the very day it began with. Rows with a NULL key have no history and are not placed.
    """
    src = reject_repeats(batch.select(*keys, *business).where(~any_null(keys)), keys)
    src = src.select(*keys, *[F.col(c).alias(f"s_{c}") for c in business])
    held = current.select(*keys, F.struct(*business, "VALID_FROM", CONFIRMED).alias("was"))
    begin = F.col("was.VALID_FROM")
    late = F.coalesce((begin > day) | ((begin == day) & ~_same(business)), F.lit(False))
    return src.join(held, list(keys), "left").withColumn("late", late)


def _same(business: Sequence[str]) -> Column:
    return F.struct(*[f"s_{c}" for c in business]).eqNullSafe(F.struct(*[F.col(f"was.{c}") for c in business]))


def split_current(rows: DataFrame, keys: Sequence[str], business: Sequence[str], day: str) -> DataFrame:
    """Versions that replace the current ones of `placed` rows that are not late.

    Equal content confirms the version for one more day. Other content splits it: what was confirmed before the day
    stays, the day opens a version, and the old content comes back with the first later day that confirmed it.
    """
    days = F.split("was." + CONFIRMED, ",")
    before, after = F.filter(days, lambda d: d < day), F.filter(days, lambda d: d > day)
    new, old = [F.col(f"s_{c}") for c in business], [F.col(f"was.{c}") for c in business]

    def version(content: Sequence[Column], begin: Column, end: Column | str, confirmed: Column) -> Column:
        end = F.lit(end) if isinstance(end, str) else end
        live = F.when(end == OPEN_END_DATE, "Y").otherwise("N")
        named = [c.alias(n) for c, n in zip(content, business, strict=True)]
        return F.struct(*named, begin.alias("VALID_FROM"), end.alias("VALID_TO"), live.alias("IS_CURRENT"), confirmed.alias(CONFIRMED))

    today, begin = F.lit(day), F.col("was.VALID_FROM")
    opened = version(new, today, OPEN_END_DATE, today)
    confirmed = version(old, begin, OPEN_END_DATE, F.array_join(F.array_sort(F.array_union(days, F.array(today))), ","))
    ended = version(old, begin, today, F.array_join(before, ","))
    passing = version(new, today, F.get(after, F.lit(0)), today)
    back = version(old, F.get(after, F.lit(0)), OPEN_END_DATE, F.array_join(after, ","))
    versions = (
        F.when(F.col("was").isNull(), F.array(opened))
        .when(_same(business), F.array(confirmed))
        .when(F.size(after) == 0, F.array(ended, opened))
        .otherwise(F.array(ended, passing, back))
    )
    return rows.where(~F.col("late")).select(*keys, F.inline(versions))


def rebuilt(rows: DataFrame, closed: DataFrame, keys: Sequence[str], business: Sequence[str], day: str) -> DataFrame:
    """All versions of the keys of late `placed` rows, from the days that confirmed each content; what the batch says of
    its day takes the place of what was said of it before. A key has one row per batch here at most."""
    late = rows.where("late")
    told = [
        late.select(*keys, *[F.col(f"was.{c}").alias(c) for c in business], F.explode(F.split("was." + CONFIRMED, ",")).alias("_day")),
        closed.join(late.select(*keys), list(keys), "left_semi").select(*keys, *business, F.explode(F.split(CONFIRMED, ",")).alias("_day")),
    ]
    now = late.select(*keys, *[F.col(f"s_{c}").alias(c) for c in business], F.lit(day).alias("_day"))
    seen = told[0].unionByName(told[1]).where(F.col("_day") != day).unionByName(now)
    by_day = Window.partitionBy(*keys).orderBy("_day")
    content = F.struct(*business)
    begins = ~content.eqNullSafe(F.lag(content).over(by_day))
    runs = seen.withColumn("_begins", begins).withColumn("_run", F.sum(F.col("_begins").cast("int")).over(by_day))
    versions = runs.groupBy(*keys, "_run").agg(
        F.min_by(content, "_day").alias("c"),
        F.min("_day").alias("VALID_FROM"),
        F.array_join(F.array_sort(F.collect_list("_day")), ",").alias(CONFIRMED),
    )
    end = F.coalesce(F.lead("VALID_FROM").over(Window.partitionBy(*keys).orderBy("VALID_FROM")), F.lit(OPEN_END_DATE))
    live = F.when(F.col("VALID_TO") == OPEN_END_DATE, "Y").otherwise("N")
    return versions.withColumn("VALID_TO", end).select(*keys, "c.*", "VALID_FROM", "VALID_TO", live.alias("IS_CURRENT"), CONFIRMED)
