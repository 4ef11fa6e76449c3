"""Row and file-name predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from carestrata.functions.cleanse import is_blank
from carestrata.settings import FileCriteria

AUDIT_STATES = ("COMPLETED", "FAILED", "IN_PROGRESS")


def in_batch(batch_id: int) -> Column:
    """Equality on the partition column, so a batch read prunes to one partition."""
    return F.col("META_BATCH_ID") == batch_id


def has_text(column: Column) -> Column:
    return ~is_blank(column)


def all_present(*columns: str) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def kind_matches(kind: str, name: Column, patterns: tuple[str, ...], extension_ci: bool = True) -> Column:
    """Does the name satisfy at least one pattern of one kind?"""
    if kind == "prefix":
        return any_of([name.startswith(p) for p in patterns])
    if kind == "suffix" or (kind == "extension" and not extension_ci):
        return any_of([name.endswith(p) for p in patterns])
    if kind == "extension":
        return any_of([F.lower(name).endswith(p.lower()) for p in patterns])
    if kind == "contains":
        return any_of([name.contains(p) for p in patterns])
    if kind == "not_contains":
        return ~any_of([name.contains(p) for p in patterns])
    if kind == "regex":
        return any_of([name.rlike(p) for p in patterns])
    raise ValueError(f"unknown file criterion {kind!r}")


def file_matches(criteria: FileCriteria, name: Column, extension_ci: bool = True) -> Column:
    """All six kinds together; a kind without patterns does not restrict."""
    kinds = {k: getattr(criteria, k).patterns for k in FileCriteria.__dataclass_fields__}
    tests = [kind_matches(k, name, p, extension_ci) for k, p in kinds.items() if p]
    return reduce(and_, tests, F.lit(True))
