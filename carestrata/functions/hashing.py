"""Row fingerprints for change detection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PIPE = "|"


def row_text(columns: Iterable[str | Column], sep: str = "") -> Column:
    """All values as one text, NULL as ''. With no separator ('AB','C') and ('A','BC') read the same;
    that is kept as the compatible form, pass `PIPE` to tell them apart."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(sep, *parts) if sep else F.concat(*parts)


def row_hash(columns: Iterable[str | Column], sep: str = "") -> Column:
    return F.md5(row_text(columns, sep))
