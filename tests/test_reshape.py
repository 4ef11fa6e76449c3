import random

import pytest
from pyspark.sql import functions as F

from carestrata.operators import reshape
from carestrata.operators.counts import load_stats, rows_per_batch, volume


@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("slots, stems", [(1, ["a"]), (5, ["a", "b"]), (12, ["a", "b", "c"])])
def test_unpivot_equals_model_in_both_forms(spark, monkeypatch, limit, slots, stems):
    monkeypatch.setattr(reshape, "STACK_CELLS", limit)
    rng = random.Random(slots)
    names = [f"{st}_{i}" for i in range(1, slots + 1) for st in stems]
    rows = [(f"k{n}", *[rng.choice([None, "", "x", "y"]) for _ in names]) for n in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["key", *names]))
    required = stems[-1]
    expected = []
    for row in rows:
        cells = dict(zip(["key", *names], row, strict=True))
        for i in range(1, slots + 1):
            if cells[f"{required}_{i}"] is not None:
                expected.append((row[0], str(i), *[cells[f"{st}_{i}"] for st in stems]))
    got = reshape.unpivot_groups(df, ["key"], stems, slots, "seq", required)
    assert got.columns == ["key", "seq", *stems]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("limit", [0, 1000])
def test_unpivot_scans_once(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(reshape, "STACK_CELLS", limit)
    spark.range(10).select("id", *[F.lit("v").alias(f"a_{i}") for i in range(1, 5)], F.lit(1).alias("unused")).write.parquet(str(tmp_path / "t"))
    plan = reshape.unpivot_groups(spark.read.parquet(str(tmp_path / "t")), ["id"], ["a"], 4, "seq")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "unused" not in text and "Exchange" not in text
    assert plan.count() == 40


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, META_BATCH_ID long")
    assert {r["META_BATCH_ID"]: r["row_count"] for r in rows_per_batch(df).collect()} == {1: 2, 2: 1}
    stats = load_stats({"T": df, "U": df.limit(0), "V": df.where("k = 'c'")}, 1)
    assert {r["table_name"]: r["row_count"] for r in stats.collect()} == {"T": 2, "U": 0, "V": 0, "TOTAL": 2}
    files = spark.createDataFrame([(1048576,), (524288,), (None,)], "size long")
    assert volume(files).first().asDict() == {"files": 3, "bytes": 1572864, "megabytes": 1.5}
    assert volume(files.limit(0)).first()["bytes"] == 0
