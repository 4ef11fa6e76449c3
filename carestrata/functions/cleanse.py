"""Column expressions of the silver layer. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the registry's mark of an open end, and the text for a missing description
OPEN_END_DATE = "2299-12-31"
MISSING_DESCRIPTION = "DESCRIPTION NOT AVAILABLE"


def display_name(entity_type: Column, last: Column, first: Column, middle: Column, organisation: Column) -> Column:
    """`LAST, FIRST[ MIDDLE]` for people (type 1), the organisation name for everybody else."""
    person = F.concat(
        F.coalesce(last, F.lit("")),
        F.lit(", "),
        F.coalesce(first, F.lit("")),
        F.coalesce(F.concat(F.lit(" "), middle), F.lit("")),
    )
    return F.when(entity_type == "1", person).otherwise(organisation)


def keep_ten_digits(number: Column) -> Column:
    """Phone or fax as written if it holds exactly ten digits, else NULL.

    One anchored match instead of strip-and-measure: no copy of the text per row.
    """
    return F.when(number.rlike(r"\A(?:[^0-9]*[0-9]){10}[^0-9]*\z"), number)


def keep_state(state: Column) -> Column:
    return F.when(F.length(state) == 2, state)


def zip5(postal: Column) -> Column:
    return F.substring(postal, 1, 5)


def zip_plus4(postal: Column, mode: str = "positional") -> Column:
    """ZIP+4. `positional` takes characters 7-10 of anything longer than 5, so `123456789` gives `789`;
    `digits` takes digits 6-9 of a nine-digit code, hyphenated or not."""
    if mode == "positional":
        return F.when(F.length(postal) > 5, F.substring(postal, 7, 4))
    digits = F.regexp_replace(postal, "[^0-9]", "")
    return F.when(F.length(digits) == 9, F.substring(digits, 6, 4))


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def blank_to(text: Column, default: str = MISSING_DESCRIPTION) -> Column:
    return F.when(is_blank(text), F.lit(default)).otherwise(text)


def open_end(end_date: Column) -> Column:
    return F.coalesce(end_date, F.lit(OPEN_END_DATE))


def active_flag(end_date: Column) -> Column:
    return F.when(open_end(end_date) == OPEN_END_DATE, "Y").otherwise("N")


def rating_category(rating: Column) -> Column:
    return (
        F.when(rating >= 4.0, "Excellent").when(rating >= 3.0, "Good").when(rating >= 2.0, "Fair").otherwise("Poor")
    )


def right_closed_bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (lo, hi] holding the value; NULL outside all of them."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges, edges[1:], labels, strict=False))):
        out = F.when((value > lo) & (value <= hi), label).otherwise(out)
    return out


AGE_EDGES = (0, 30, 40, 100)
AGE_LABELS = ("Young", "Middle", "Senior")


def age_group(age: Column) -> Column:
    return right_closed_bins(age, AGE_EDGES, AGE_LABELS)


def tolerant_number(text: Column) -> Column:
    """Whole number, rounding a fractional text; NULL when the text is no number or has no room in a long."""
    return text.try_cast("decimal(38,0)").try_cast("bigint")
