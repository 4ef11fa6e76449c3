import pytest

ODD = "doc_id long, text string, row string, key long, h int, score string, copy int, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names operators use themselves."""

    def make(rows, source=lambda i: "a"):
        full = [(i, t, "r", 1, 2, "s", 3, source(i), None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, ODD)

    return make


@pytest.fixture
def prose():
    """Repeatable invented sentences."""
    import random

    def make(seed, n):
        r = random.Random(str(seed))
        return ["".join(r.choice("abcdefgé") for _ in range(r.randint(2, 7))) for _ in range(n)]

    return make
