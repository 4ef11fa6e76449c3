from datetime import datetime

import pytest

from carestrata.operators.merge import BatchStamp
from carestrata.plans.history import StoredHistory
from carestrata.settings import TargetTable

TARGET = TargetTable("T", ("k",), ("a", "b"))
DDL = "k string, a string, b string"
OPEN = "2299-12-31"


def stamp(n):
    return BatchStamp("P", "S", n, datetime(2024, 1, 1))


def plain(batches):
    """Versions by definition: the last word on each day, equal neighbours as one."""
    told = {}
    for day, rows in batches:
        for k, a, b in rows:
            told.setdefault(k, {})[day] = (a, b)
    out = []
    for k, days in told.items():
        runs = []
        for day in sorted(days):
            if runs and runs[-1][0] == days[day]:
                runs[-1][2].append(day)
            else:
                runs.append((days[day], day, [day]))
        for i, (content, begin, seen) in enumerate(runs):
            end = runs[i + 1][1] if i + 1 < len(runs) else OPEN
            out.append((k, *content, begin, end, "Y" if end == OPEN else "N", ",".join(seen)))
    return sorted(map(str, out))


def held(history):
    rows = history.versions().select("k", "a", "b", "VALID_FROM", "VALID_TO", "IS_CURRENT", "CONFIRMED_DAYS").collect()
    return sorted(str(tuple(r)) for r in rows)


def taken(spark, root, batches):
    history = StoredHistory(spark, str(root), TARGET, 2)
    for n, (day, rows) in enumerate(batches, 1):
        history.take(spark.createDataFrame(rows, DDL), day, stamp(n))
    return history


BATCHES = [
    ("2024-01-01", [("x", "1", None), ("y", "1", "b"), ("w", "7", "")]),
    ("2024-02-01", [("x", "2", None), ("y", "1", "b"), ("w", "7", None)]),
    ("2024-03-01", [("x", "1", None), ("z", "9", "b"), ("w", "7", None)]),
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_any_order_gives_the_same_versions(spark, tmp_path, order):
    history = taken(spark, tmp_path, [BATCHES[i] for i in order])
    assert held(history) == plain(BATCHES)
    assert {r["k"]: r["a"] for r in history.on("2024-02-15").collect()} == {"x": "2", "y": "1", "w": "7"}


def test_a_batch_again_changes_its_own_day_only(spark, tmp_path):
    again = [*BATCHES, ("2024-02-01", [("x", "1", None), ("y", "3", "b")]), ("2024-01-01", [("x", "5", "c")])]
    assert held(taken(spark, tmp_path, again)) == plain(again)


def test_null_keys_repeats_and_no_rows(spark, tmp_path):
    history = taken(spark, tmp_path, BATCHES[:1])
    before = held(history)
    none = history.take(spark.createDataFrame([], DDL), "2024-05-01", stamp(8))
    assert none == {"rows": 0, "keyless": 0, "late": 0, "closed": 0}
    done = history.take(spark.createDataFrame([(None, "1", "1"), (None, "1", "1")], DDL), "2024-05-01", stamp(9))
    assert done["keyless"] == 2 and held(history) == before
    with pytest.raises(Exception, match="key twice"):
        history.take(spark.createDataFrame([("x", "1", "1"), ("x", "2", "1")], DDL), "2024-05-01", stamp(10))
    assert held(history) == before
    with pytest.raises(ValueError):
        history.take(spark.createDataFrame([("x", "1", "1")], DDL), OPEN, stamp(11))


def test_only_hit_buckets_are_written(spark, tmp_path):
    history = StoredHistory(spark, str(tmp_path), TARGET, 8)
    history.take(spark.createDataFrame([(str(i), "1", "1") for i in range(64)], DDL), "2024-01-01", stamp(1))
    done = history.take(spark.createDataFrame([("5", "2", "1")], DDL), "2024-02-01", stamp(2))
    assert done == {"rows": 1, "keyless": 0, "late": 0, "closed": 1}
    head = history.current.head()
    assert sum(f"/v={head.version}/" in r["path"] for r in history.current.manifest(head)) == 1
    assert history.current.current().count() == 64 and history.closed.current().count() == 1


def test_a_batch_is_computed_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            made.add(len(part))
            yield part

    rows = [(str(i), "a", "1") for i in range(20)] + [(None, "a", "1")]
    batch = spark.createDataFrame(rows, "k string, a string, b string").mapInPandas(counted, "k string, a string, b string")
    counts = StoredHistory(spark, str(tmp_path / "h"), TargetTable("T", ("k",), ("a", "b")), 3).take(batch, "2024-01-01", BatchStamp("P", "S", 1, datetime(2024, 1, 1)))
    assert (counts["rows"], counts["keyless"], made.value) == (21, 1, 21)
