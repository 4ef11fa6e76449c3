import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from carestrata.session import build_session  # noqa: E402

# made at import, since test modules name columns at module level
SESSION = build_session(
    "tests",
    "local[4]",
    **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
    },
)
SESSION.sparkContext.setLogLevel("OFF")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def one(spark):
    """Value of a column expression over a one-row frame of named texts."""

    def value(expression, **texts):
        ddl = ", ".join(f"{k} string" for k in texts) or "x string"
        row = tuple(texts.values()) or (None,)
        return spark.createDataFrame([row], ddl).select(expression.alias("v")).first()["v"]

    return value


@pytest.fixture
def many(spark):
    """Values of a column expression over rows of one text column `x`."""

    def values(expression, inputs):
        rows = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, x string").select("i", expression.alias("v"))
        return [r["v"] for r in df.orderBy("i").collect()]

    return values
