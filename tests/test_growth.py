"""What keeps a task's share bounded, or a row's cost low, as tables grow."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carestrata.plans.tables import BatchTable
from carestrata.sources import records
from carestrata.verification import landing, silver, stored_state, whole_jobs, wide_files


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_python_gets_rows_by_size(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    wide = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("content"))
    assert wide.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 5 << 20


def test_wide_rows_are_not_fused(spark, tmp_path):
    cells = spark.range(5).select(F.lit(1).cast("bigint").alias("META_BATCH_ID"), *[F.col("id").cast("string").alias(f"c{i}") for i in range(330)])
    table = BatchTable(spark, str(tmp_path / "bronze"))
    table.replace(cells, 1)
    read = table.read(1).select(F.md5(F.concat(*[f"c{i}" for i in range(330)])))
    assert "*(" not in planned(read) and read.distinct().count() == 5


def test_records_over_lines_share_a_batch():
    lines = ['k,v'] + ['1,"a', 'b"'] * 500
    columns = [pa.array(["f"] * len(lines)), pa.array([0] * len(lines), pa.int64()), pa.array([False] * len(lines)), pa.array(lines)]
    out = list(records._by_split(",")(iter([pa.RecordBatch.from_arrays(columns, ["path", "block", "inside", "value"])])))
    assert len(out) < 6
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["text"] for r in rows if r["first"]] == ["k,v"]
    assert [r["text"] for r in rows if not r["first"]] == ['1,"a\nb"'] * 500


def test_pieces_of_a_file_grow_with_it(spark, tmp_path):
    for name, size in (("small", 1000), ("large", 8 << 20)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text("x" * size)
    seen = {}
    for name in ("small", "large"):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")

        def read(name=name):
            seen[name] = spark.conf.get("spark.sql.files.maxPartitionBytes")
            return spark.range(1)

        wide_files._small_splits(spark, str(tmp_path / name), read, "t")
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert seen == {"small": "65536b", "large": "131072b"}


def test_buckets_grow_with_rows():
    assert [landing._buckets(n) for n in (0, 150_000, 9_000_000, 54_000_000)] == [2, 2, 4, 27]


def test_pivot_exchanges_once(spark, tmp_path):
    rows = [(k, k % 7, "2020-01-01", float(k)) for k in range(300)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate string, o_totalprice double")
    orders.withColumn("o_orderdate", F.to_date("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    found = silver.unpivot_groups_wide(spark, str(tmp_path))
    assert planned(found).count("Exchange ") == 1
    assert found.count() == len({(k % 7, k % 50) for k in range(300)})


def test_buckets_of_jobs_grow_with_rows(spark, tmp_path, monkeypatch):
    class Made(Exception):
        pass

    def lake(spark, root, buckets):
        raise Made(buckets)

    for module, query, name, rows, buckets in ((whole_jobs, "code_set_pipeline", "part", 1_200_000, 12), (stored_state, "history_late_batch", "lineitem", 9_000_000, 9)):
        monkeypatch.setattr(module, "Lake", lake)
        spark.range(rows).withColumn("l_linenumber", F.col("id")).write.parquet(str(tmp_path / f"{name}.parquet"))
        with pytest.raises(Made, match=f"^{buckets}$"):
            getattr(module, query)(spark, str(tmp_path))
