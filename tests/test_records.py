import csv
import io
import random

import pytest

from carestrata.sources import delimited, records


@pytest.fixture
def tiny_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(6))
def test_records_over_many_splits(spark, tmp_path, tiny_splits, seed):
    r = random.Random(seed)
    cells = ["", "a", "b c", 'say "so"', "two\nlines", "x, y", "\n\n", '"', "é" * 9, "long " * 20 + "\n" + "tail"]
    files = {}
    for n in range(3):
        rows = [["k", f"v{n}", "w"]] + [[str(i), r.choice(cells), r.choice(cells)] for i in range(r.randint(0, 25))]
        buffer = io.StringIO()
        csv.writer(buffer, lineterminator=r.choice(["\n", "\r\n"])).writerows(rows)
        text = buffer.getvalue() if r.random() < 0.5 else "\n" + buffer.getvalue() + "  \n\n"
        path = tmp_path / f"file {n}+.csv"
        path.write_bytes(("﻿" * (n == 1) + text).encode())
        files[path.name] = rows
    found = records.csv_records(spark, str(tmp_path)).collect()
    for name, rows in files.items():
        own = [x for x in found if records.decoded_path(x["path"]).endswith(name)]
        parse = lambda t: next(csv.reader(io.StringIO(t, newline="")))
        assert [parse(x["record"]) for x in own if x["first"]] == rows[:1]
        assert sorted(parse(x["record"]) for x in own if not x["first"]) == sorted(rows[1:])
        read = delimited.csv_strings(spark, str(tmp_path / name), multiline=True)
        assert read.columns == rows[0]
        assert sorted(tuple(x or "" for x in row) for row in read.collect()) == sorted(map(tuple, rows[1:]))


def test_one_quoted_break_is_read_by_several_tasks(spark, tmp_path, tiny_splits):
    rows = ["k,v", '0,"two\nlines"', *(f"{i},x" for i in range(1, 200))]
    (tmp_path / "a.csv").write_text("\n".join(rows) + "\n")
    from pyspark.sql import functions as F

    read = delimited.csv_strings(spark, str(tmp_path / "a.csv"), multiline=True).withColumn("task", F.spark_partition_id())
    got = read.collect()
    assert len(got) == 200 and len({r["task"] for r in got}) > 4
    assert [r["v"] for r in got if r["k"] == "0"] == ["two\nlines"]


def test_a_quote_that_never_closes(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text('k,v\n1,a\n2,"open\n' + "3,b\n" * 40)
    found = sorted(x["record"] for x in records.csv_records(spark, str(tmp_path / "a.csv")).collect())
    assert len(found) == 3 and found[1].startswith('2,"open\n3,b') and found[1].count("\n") == 40


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,one\n")
    (tmp_path / "b.csv").write_text('v,id\n"two\nlines",2\n')
    (tmp_path / "c.csv").write_text("id,more\n3,x\n")
    rows = delimited.csv_strings(spark, str(tmp_path)).select("id", "v", "more").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "one", None), ("2", "two\nlines", None), ("3", None, "x")]
    named = delimited.csv_by_name(spark, str(tmp_path), ["V", "ID"])
    assert sorted((r["ID"], r["V"]) for r in named.collect() if r["V"]) == [("1", "one"), ("2", "two\nlines")]
    with pytest.raises(delimited.HeaderMismatch):
        delimited.csv_positional(spark, str(tmp_path), ["A", "B"])


def test_equal_stems_keep_their_folders(spark, tmp_path):
    for folder, value in (("a", "1"), ("b", "2")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text(f"v\n{value}\n")
    (tmp_path / "y.csv").write_text("v\n3\n")
    out = str(tmp_path / "out")
    files = [str(tmp_path / p) for p in ("a/x.csv", "b/x.csv", "y.csv")]
    written = delimited.csv_to_parquet(spark, files, out)
    assert written == [f"{out}/a/x.parquet", f"{out}/b/x.parquet", f"{out}/y.parquet"]
    assert [spark.read.parquet(p).first()["v"] for p in written] == ["1", "2", "3"]
    with pytest.raises(ValueError):
        delimited.csv_to_parquet(spark, [files[0]] * 2, out)
