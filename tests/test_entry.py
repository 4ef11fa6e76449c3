from pathlib import Path

import pytest

import __spark_entry__ as entry
from carestrata.verification import catalogue

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE)
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(catalogue.QUERIES) >= 50


@pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the given tables")
def test_entry(spark):
    first = entry.entry(spark)
    assert first.count() > 0
    assert first.columns[:2] == ["META_PROGRAM_NAME", "META_SUBJECT_AREA"]
