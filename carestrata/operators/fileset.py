"""Completeness of landed file sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.operators.predicates import kind_matches
from carestrata.settings import FileCriteria


def in_view(criteria: FileCriteria, name: Column) -> Column:
    """Extension (case-sensitive here) and exclusion decide which files are looked at at all."""
    tests = [F.lit(True)]
    if criteria.extension.patterns:
        tests.append(kind_matches("extension", name, criteria.extension.patterns, extension_ci=False))
    if criteria.not_contains.patterns:
        tests.append(kind_matches("not_contains", name, criteria.not_contains.patterns))
    return reduce(and_, tests)


def counted_criteria(criteria: FileCriteria, name: Column) -> dict[str, Column]:
    seen = in_view(criteria, name)
    return {
        kind: seen & kind_matches(kind, name, c.patterns) if c.patterns else F.lit(False)
        for kind, c in criteria.counting().items()
    }


def set_completeness(
    files: DataFrame, criteria: FileCriteria, name: str = "name", by: Sequence[str] = (), notified: Column | None = None
) -> DataFrame:
    """One row per file set (`by` columns): files found per criterion, totals and the set's state.

    Every counting criterion must be met exactly, the extension count is a minimum. A file meeting two criteria
    counts twice. All counts come from one partially aggregated pass.
    """
    counted = counted_criteria(criteria, F.col(name))
    seen = in_view(criteria, F.col(name))
    counts = files.groupBy(*by).agg(
        *[F.count_if(cond).alias(f"found_{kind}") for kind, cond in counted.items()],
        F.count_if(seen).alias("seen"),
        *([F.max(notified).alias("notified")] if notified is not None else []),
    )
    exact = [F.col(f"found_{k}") == c.count for k, c in criteria.counting().items()]
    complete = reduce(and_, [*exact, F.col("seen") >= criteria.extension.count])
    found = reduce(lambda a, b: a + b, [F.col(f"found_{k}") for k in counted], F.lit(0).cast("bigint"))
    told = F.col("notified") if notified is not None else F.lit(False)
    expected = F.lit(criteria.expected_total).cast("bigint")
    state = (
        F.when(complete & told, "COMPLETE_NOTIFIED")
        .when(complete, "COMPLETE")
        .when(found < expected, "INCOMPLETE")
        .when(found > expected, "EXCESS_FILES")
        .otherwise("CRITERIA_NOT_MET")
    )
    return counts.select(
        *by,
        *[f"found_{k}" for k in counted],
        found.alias("found_total"),
        expected.alias("expected_total"),
        complete.alias("complete"),
        (found >= expected).alias("enough"),
        state.alias("state"),
    )


def matched_files(files: DataFrame, criteria: FileCriteria, name: str = "name") -> DataFrame:
    """Distinct files meeting at least one counting criterion."""
    counted = list(counted_criteria(criteria, F.col(name)).values())
    return files.where(reduce(or_, counted, F.lit(False))).select(name).distinct()


def due_sets(states: DataFrame, fired: DataFrame, key: str) -> DataFrame:
    """Complete sets not fired yet for their present file count; a changed count arms a set again."""
    return states.where(F.col("complete")).join(fired.select(key, "found_total"), [key, "found_total"], "left_anti")
