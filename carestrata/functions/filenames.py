"""Derivations from file names: cleaned name, table name, type, size text, transaction id."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extension is the last dot of the base name and what follows, provided something other than a dot precedes it.
_EXTENSION = r"[^/.][^/]*(\.[^/.]*)\z"

# --- fixed values: stamps cut from file names ---------------------------------------------------------------
# A name with one of these markers is cut right after the marker, and no general rule is applied then.
MARKERS = ("_TB", "_TBL")
MARKER_STAMPS = (
    r"_\d{4}_\d{2}_\d{2}T\d{6}Z?",
    r"_\d{4}_\d{2}_\d{2}",
    r"_\d{8}T\d{6}Z?",
)
# Otherwise each of these is removed in turn, with everything that follows it.
GENERAL_STAMPS = (
    r"_\d{8}-\d{8}.*",
    r"_\d{4}_\d{2}_\d{2}T\d{6}Z?.*",
    r"_\d{4}_\d{2}_\d{2}_\d{4,6}.*",
    r"_\d{4}-\d{2}-\d{2}T\d{6}Z?.*",
    r"_\d{4}-\d{2}-\d{2}_\d{4,6}.*",
    r"_\d{8}T\d{6}Z?.*",
    r"_\d{8}_\d{4,6}.*",
    r"_\d{14}.*",
    r"_\d{12}.*",
    r"_\d{10}.*",
    r"T\d{6}Z?.*",
    r"_\d{4}_\d{2}_\d{2}.*",
    r"_\d{8}.*",
    r"_\d{1,4}$",
)
EMPTY_NAME = "file"
FILE_TYPES = {".csv": "CSV", ".parquet": "PARQUET", ".txt": "TEXT", ".xlsx": "EXCEL", ".xls": "EXCEL", ".zip": "ZIP"}
# --- end of fixed values ------------------------------------------------------------------------------------


def extension(name: Column) -> Column:
    return F.regexp_extract(name, _EXTENSION, 1)


def stem(name: Column) -> Column:
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(name)))


def clean_file_name(name: Column) -> Column:
    """Name without date and time stamps, extension kept."""
    base = stem(name)
    general = base
    for pattern in GENERAL_STAMPS:
        general = F.regexp_replace(general, pattern, "")
    general = F.regexp_replace(general, r"[_-]+\z", "")
    cleaned = F.when(general == "", EMPTY_NAME).otherwise(general)
    for stamp in reversed(MARKER_STAMPS):
        for marker in reversed(MARKERS):
            pattern = rf"\A(.+{marker}){stamp}.*"
            cleaned = F.when(base.rlike(pattern), F.regexp_replace(base, pattern, "$1")).otherwise(cleaned)
    return F.concat(cleaned, extension(name))


def table_name(file_name: Column, ext: str = ".csv", suffix: str = "") -> Column:
    """File name without its extension (any case), plus `suffix` unless it is already there."""
    base = F.regexp_replace(file_name, rf"(?i){re.escape(ext)}\z", "")
    return F.when(base.endswith(suffix), base).otherwise(F.concat(base, F.lit(suffix))) if suffix else base


def file_type(name: Column) -> Column:
    ext = F.lower(extension(name))
    known = F.create_map(*[F.lit(x) for pair in FILE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, ext), F.upper(F.ltrim(ext, F.lit("."))))


def size_text(size: Column) -> Column:
    return F.coalesce(F.concat(size.cast("string"), F.lit("B")), F.lit("UNKNOWN"))


def transaction_id(program: Column, subject: Column, day: Column, batch: Column, number: Column) -> Column:
    return F.concat_ws("_", program, subject, day.cast("string"), batch.cast("string"), number.cast("string"))
