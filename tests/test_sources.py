import csv
import io
import random
import zipfile
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carestrata.operators.merge import BatchStamp
from carestrata.sources import columnar, delimited, files, pages

STAMP = BatchStamp("P", "S", 1, datetime(2024, 1, 1))


def write_csv(path, header, rows, **options):
    with open(path, "w", newline="") as f:
        writer = csv.writer(f, **options)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def test_by_name_ignores_case_and_fills_missing(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", ["Zip", "NAME", "extra"], [["00501", "x", "e"], ["", 'q"q', "e"]])
    df = delimited.csv_by_name(spark, path, ["name", "ZIP", "gone"])
    assert df.columns == ["name", "ZIP", "gone"]
    assert sorted(map(tuple, df.collect()), key=str) == [('q"q', None, None), ("x", "00501", None)]
    strict = delimited.csv_by_name(spark, path, ["NAME", "ZIP"], case_sensitive=True)
    assert {r["ZIP"] for r in strict.collect()} == {None}


def test_positional_checks_width(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", ["Some Name", "Other"], [["1", "2"]])
    assert delimited.csv_positional(spark, path, ["A", "B"]).first().asDict() == {"A": "1", "B": "2"}
    with pytest.raises(delimited.HeaderMismatch):
        delimited.csv_positional(spark, path, ["A"])


def test_inferred_skips_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,v\n1,a\n2,b,c,d\n3,c\n")
    df = delimited.csv_inferred(spark, str(tmp_path / "a.csv"))
    assert df.schema["n"].dataType.typeName() == "integer"
    assert sorted(r["n"] for r in df.collect()) == [1, 3]


def test_csv_to_parquet_keeps_text(spark, tmp_path):
    path = write_csv(tmp_path / "CLAIMS_a.csv", ["zip"], [["00501"]])
    (written,) = delimited.csv_to_parquet(spark, [path], str(tmp_path / "out"))
    assert written.endswith("/CLAIMS_a.parquet")
    assert spark.read.parquet(written).first()["zip"] == "00501"


def test_demo_people(spark, tmp_path):
    from carestrata.functions.cleanse import age_group

    source = write_csv(tmp_path / "people.csv", ["id", "name", "age"], [[1, "a", 25], [2, "b", 40], [3, "c", 77]])
    delimited.add_column_csv(spark, source, str(tmp_path / "out"), "age_group", age_group(F.col("age")))
    back = delimited.csv_strings(spark, str(tmp_path / "out"))
    assert {r["id"]: r["age_group"] for r in back.collect()} == {"1": "Young", "2": "Middle", "3": "Senior"}


def test_headers(spark, tmp_path):
    one = tmp_path / "one.csv"
    one.write_text('﻿"a, b", c ,,"d"\n1,2,3,4\n', encoding="utf-8")
    (tmp_path / "none.csv").write_text("")
    paths = [str(one), str(tmp_path / "none.csv")]
    parsed = {r["object_name"]: r["actual"] for r in delimited.csv_headers(spark, paths).collect()}
    assert parsed == {"one": ["a, b", " c ", "", "d"], "none": []}
    (tmp_path / "tall.csv").write_text('"a\nb",c\n1,2\n')
    assert delimited.csv_headers(spark, [str(tmp_path / "tall.csv")]).first()["actual"] == ["a\nb", "c"]
    naive = {r["file_name"]: r["actual"] for r in delimited.csv_headers(spark, paths, naive=True).collect()}
    assert naive == {"one.csv": ["a", "b", "c", "d"], "none.csv": []}


def test_metadata_map(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('FileName, Cols \na.csv,"x, y,,z"\n,"q"\nb.csv,\na.csv,"last"\n')
    rows = {r["file_name"]: r["columns"] for r in delimited.metadata_map(spark, str(path)).collect()}
    assert rows == {"a.csv": ["last"]}
    (tmp_path / "bad.csv").write_text("x,cols\n1,2\n")
    with pytest.raises(delimited.HeaderMismatch):
        delimited.metadata_map(spark, str(tmp_path / "bad.csv"))


def test_column_mapping(spark, tmp_path):
    path = tmp_path / "m.sql"
    path.write_text('"Code (main)" AS CODE,\n-- note\n\n"Display Name" AS DISPLAY_NAME\n')
    assert delimited.column_mapping(spark, str(path)) == [("Code (main)", "CODE"), ("Display Name", "DISPLAY_NAME")]
    path.write_text('"Code" CODE,\n')
    with pytest.raises(ValueError, match="no column mapping"):
        delimited.column_mapping(spark, str(path))


@pytest.mark.parametrize("split", ["97", "256", "134217728"])
def test_record_counts_match_a_csv_parser_for_any_split(spark, tmp_path, split):
    rng = random.Random(int(split))
    cells = ["", "a", "x,y", 'q"q', "two\nlines", "\n\n", '"', '""\n"', "end"]
    for n in range(6):
        rows = [[rng.choice(cells) for _ in range(3)] for _ in range(rng.randint(0, 60))]
        rows = [r if any(r) else ["k", *r[1:]] for r in rows]
        write_csv(tmp_path / f"t{n}.csv", ["a", "b", "c"], rows, quoting=[csv.QUOTE_MINIMAL, csv.QUOTE_ALL][n % 2])
    with open(tmp_path / "odd.csv", "w") as f:
        f.write('a,b\n\n5" pipe,2\n\n"open ""x\n\n",3\nx"",y"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["file_name"]: r for r in delimited.csv_profile(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for path in tmp_path.glob("*.csv"):
        frame = pd.read_csv(path, dtype=str)
        assert got[path.name]["actual_rows"] == len(frame), path.name
        assert got[path.name]["TABLE_NAME"] == path.stem
        broken = frame.map(lambda v: isinstance(v, str) and "\n" in v).to_numpy().any()
        if broken:
            assert got[path.name]["multiline"]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    with zipfile.ZipFile(folder / "B.ZIP", "w") as z:
        z.writestr("dir/", "")
        z.writestr("dir/A_TB_2025_07_18.csv", "a,b\n1,2\n3,4\n")
        z.writestr("npidata_pfile_1_fileheader.csv", "x\n")
        z.writestr("npidata_pfile_20250707-20250713.csv", "n\r\n1\r\n")
        z.writestr("npidata_pfile_2.csv", "".join(f"line {i}\n" for i in range(5000)))
    (folder / "c d.csv").write_text("x\n")
    return str(folder)


def test_inventory_and_members(spark, landing):
    inventory = {r["name"]: r["size"] for r in files.file_inventory(spark, landing).collect()}
    assert set(inventory) == {"B.ZIP", "c d.csv"} and inventory["c d.csv"] == 2
    members = files.archive_members(spark, landing)
    assert [r["member"] for r in members.orderBy("ordinal").collect()][:2] == ["dir/", "dir/A_TB_2025_07_18.csv"]
    assert files.first_member(members, "npidata_pfile").first()["member"] == "npidata_pfile_20250707-20250713.csv"


def test_extraction_keeps_line_order(spark, landing, tmp_path):
    """Long members come in many batches; members with the same cleaned name stay separate files."""
    files.extract_archives(spark, landing, str(tmp_path / "out"))
    made = [(p.parent.parent.name.removeprefix("file_name="), p.read_text()) for p in (tmp_path / "out").glob("*/*/*.txt")]
    long = "".join(f"line {i}\n" for i in range(5000))
    assert sorted(made) == sorted([
        ("A_TB.csv", "a,b\n1,2\n3,4\n"), ("npidata_pfile_1_fileheader.csv", "x\n"), ("npidata_pfile.csv", "n\n1\n"), ("npidata_pfile.csv", long),
    ])
    profile = files_by_table(delimited.csv_profile(spark, str(tmp_path / "out")))
    assert profile == {"A_TB": 2, "npidata_pfile_1_fileheader": 0, "npidata_pfile": 1 + 4999}
    both = delimited.csv_strings(spark, f"{tmp_path}/out/file_name=A_TB.csv")
    assert both.columns == ["a", "b"]


def files_by_table(profile):
    return {r["TABLE_NAME"]: r["n"] for r in profile.groupBy("TABLE_NAME").agg(F.sum("actual_rows").alias("n")).collect()}


def test_line_batches(monkeypatch):
    monkeypatch.setattr(files, "BYTES_PER_BATCH", 300)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.txt", "".join(f"line {i}\n" for i in range(1000)))
        z.writestr("b.csv", "x\r\ny")
    batch = pa.RecordBatch.from_pydict({"path": ["p"], "content": [buffer.getvalue()]})
    out = list(files._read_lines(iter([batch])))
    rows = [r for b in out for r in b.to_pylist()]
    assert len(out) > 10 and [r["line_no"] for r in rows] == [*range(1000), 0, 1]
    assert [r["value"] for r in rows] == [*(f"line {i}" for i in range(1000)), "x\r", "y"]


def test_releases_not_loaded(spark):
    releases = spark.createDataFrame(
        [("X_Dissemination_070725_071325_Weekly_V2.zip",), ("X_Dissemination_071425_072025_Weekly_V2.zip",),
         ("X_Dissemination_July_2025_V2.zip",), ("X_Dissemination_June_2025_V2.zip",)], "name string")
    there = spark.createDataFrame(
        [("npidata_pfile_20250707-20250713_x.csv",), ("npidata_pfile_202507_monthly.csv",), ("npidata_pfile_20250714-20250720.zip",)],
        "name string")
    left = files.not_loaded(releases, there, datetime(2025, 8, 1))
    assert sorted(r["name"] for r in left.collect()) == ["X_Dissemination_071425_072025_Weekly_V2.zip", "X_Dissemination_June_2025_V2.zip"]
    assert files.not_present(releases, releases.limit(1)).count() == 3


def test_page_links(spark):
    html = (
        '<a class="x" href="/a?x=1&amp;y=2"> <b>T</b> </a><A HREF=\'http://q/z.zip\'>u</A><a name=k>no</a>'
        '<a href=foo>w</a><abbr href="no">q</abbr>'
    )
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = [(r["href"], r["link_text"]) for r in pages.page_links(df).orderBy("ordinal").collect()]
    assert got == [("/a?x=1&y=2", "T"), ("http://q/z.zip", "u"), ("foo", "w")]


def test_release_choice(spark):
    links = spark.createDataFrame(
        [(1, n, h, t) for n, (h, t) in enumerate([
            ("/x_nucc_taxonomy_240.csv", "old"), ("f/a_csv", "Current version"), ("http://h/nucc_taxonomy_251.csv", "Version 2025_1"),
            ("/W_Dissemination_070725_071325_Weekly_V2.zip", ""), ("/W_Dissemination_071425_072025_Weekly_V2.zip", ""),
            ("/M_Dissemination_July_2025_V2.zip", ""), ("/M_Dissemination_July_2025.zip", "")])],
        "page_id int, ordinal int, href string, link_text string")
    best = {v: pages.code_set_link(links, v).first()["name"] for v in ("2025.1", "2025.2")}
    assert best == {"2025.1": "nucc_taxonomy_251.csv", "2025.2": "a_csv"}
    latest = {r["kind"]: r["name"] for r in pages.latest_releases(pages.registry_releases(links)).collect()}
    assert latest == {"weekly": "W_Dissemination_071425_072025_Weekly_V2.zip", "monthly": "M_Dissemination_July_2025_V2.zip"}


def test_parquet_loads(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame([(1, "x")], "Id int, NAME string").write.parquet(path)
    existing = spark.createDataFrame([(0, "o", "e")], "ID int, NAME string, EXTRA string")
    row = columnar.parquet_into(spark, path, existing.schema).first().asDict()
    assert row == {"ID": 1, "NAME": "x", "EXTRA": None}
    stamped = columnar.parquet_by_name(spark, path, ["name", "other"], STAMP).first().asDict()
    assert (stamped["name"], stamped["other"], stamped["META_BATCH_ID"]) == ("x", None, 1)
    seen = columnar.with_provenance(spark.read.parquet(path), datetime(2024, 1, 1)).first()
    assert "p.parquet" in seen["_source_file"] and seen["_loaded_at"] == datetime(2024, 1, 1)
    assert columnar.file_tables(["/a/x.parquet", "/a/y_T.PARQUET"], "_T") == {"x_T": ["/a/x.parquet"], "y_T": ["/a/y_T.PARQUET"]}


def test_bytes_survive_zip(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("ü.txt", "é\n\nlast")
    df = spark.createDataFrame([("p", buffer.getvalue())], "path string, content binary")
    assert [(r["line_no"], r["value"]) for r in files.member_lines(df).orderBy("line_no").collect()] == [(0, "é"), (1, ""), (2, "last")]
