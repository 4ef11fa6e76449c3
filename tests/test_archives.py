import os
import random
import zipfile

import pytest

from carestrata.sources import archives, files


def packed(path, members, compression=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", compression) as z:
        for name, data in members:
            z.writestr(name, data)


def contents(spark, folder):
    out, verdicts = {}, {}
    rows = archives.member_bytes(spark, archives.archive_directory(spark, str(folder))).collect()
    for r in sorted(rows, key=lambda r: (r["path"], r["ordinal"], r["chunk"])):
        key = os.path.basename(r["path"]), r["member"]
        if r["content"] is None:
            verdicts[key] = r["problem"]
        else:
            out[key] = out.get(key, b"") + bytes(r["content"])
    return out, verdicts


@pytest.fixture
def small_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("compression", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_every_member_comes_whole(spark, tmp_path, small_splits, compression):
    r = random.Random(1)
    members = [("A.csv", "k,v\n1,a\n"), ("B.psv", "x|y"), ("C", b""), ("d/E.csv.gz", r.randbytes(20_000)), ("\né.bin", b"\n" * 9000), ("big.txt", b"line\n" * 300_000)]
    packed(tmp_path / "one file.zip", members, compression)
    packed(tmp_path / "two.ZIP", [("A.csv", b"other"), ("folder/", b"")], compression)
    found, verdicts = contents(spark, tmp_path)
    want = {("one file.zip", n): (d.encode() if isinstance(d, str) else d) for n, d in members} | {("two.ZIP", "A.csv"): b"other"}
    assert found == {k: v for k, v in want.items() if v}
    assert verdicts == dict.fromkeys(want)


def test_listing_reads_the_directory_only(spark, tmp_path):
    packed(tmp_path / "a.zip", [("x.csv", b"1" * 5000), ("y.csv", b"2" * 70_000)], zipfile.ZIP_STORED)
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[100:4000] = bytes(3900)  # the bodies are gone, the directory isn't
    (tmp_path / "a.zip").write_bytes(bytes(data))
    assert [(r["member"], r["size"]) for r in files.archive_members(spark, str(tmp_path)).orderBy("ordinal").collect()] == [("x.csv", 5000), ("y.csv", 70_000)]
    _, verdicts = contents(spark, tmp_path)
    assert verdicts == {("a.zip", "x.csv"): "bytes don't match the checksum", ("a.zip", "y.csv"): None}
    with pytest.raises(Exception, match="checksum"):
        files.extract_archives(spark, str(tmp_path), str(tmp_path / "out"))


def test_what_cant_be_inflated_is_reported(spark, tmp_path):
    packed(tmp_path / "a.zip", [("x.bin", b"1" * 500)], zipfile.ZIP_BZIP2)
    assert contents(spark, tmp_path) == ({}, {("a.zip", "x.bin"): "compression method 12"})


def test_extraction_keeps_other_members_as_bytes(spark, tmp_path):
    packed(tmp_path / "a.zip", [("A.csv", "k\n1"), ("B.psv", b"p\xff"), ("docs/C", b"c")])
    out = str(tmp_path / "out")
    assert files.extract_archives(spark, str(tmp_path), out) == ["B.psv", "docs/C"]
    kept = spark.read.parquet(f"{out}.members").where("content IS NOT NULL").collect()
    assert {r["member"]: bytes(r["content"]) for r in kept} == {"B.psv": b"p\xff", "docs/C": b"c"}
    assert [r["value"] for r in spark.read.text(out).collect()] == ["k", "1"]


def test_many_archives_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Small archives are no longer opened one by one on the driver; a large one still is, and so are odd names."""
    for i in range(40):
        packed(tmp_path / f"{i}.zip", [("A.csv", f"k\n{i}\n"), ("folder/", b"")])
    packed(tmp_path / "large.zip", [("A.csv", os.urandom(9000))], zipfile.ZIP_STORED)
    packed(tmp_path / "odd[1].zip", [("A.csv", "odd")])
    monkeypatch.setattr(archives, "WHOLE", 8000)
    by_driver, plain = [], archives.directory
    monkeypatch.setattr(archives, "directory", lambda spark, path: by_driver.append(path.rsplit("/", 1)[-1]) or plain(spark, path))
    listed = archives.archive_directory(spark, str(tmp_path))
    assert sorted(by_driver) == ["large.zip", "odd[1].zip"]
    paths = [r["path"] for r in listed.select("path").distinct().collect()]
    assert len(paths) == 42 and listed.count() == 82
    want = sorted(row for path in paths for row in plain(spark, path))
    assert sorted(tuple(r) for r in listed.collect()) == want
    some = sorted(paths)[:3]
    assert sorted({r["path"] for r in archives.archive_directory(spark, str(tmp_path), some).collect()}) == some
