"""What lands in practice: equal names, foreign files, quoted breaks, empty re-runs, wide tables."""

import io
import zipfile
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from carestrata import session
from carestrata import settings as s
from carestrata.operators.merge import BatchStamp
from carestrata.operators.rules import Rule, run_rules
from carestrata.plans import jobs, loads, sqltext, tables
from carestrata.sources import delimited, files

AT = datetime(2024, 1, 1)
CONFIG = s.ProgramConfig("MEDICAID", "RECIPIENT", s.FileCriteria(prefix=s.Criterion(("R_MMIS",), 4)), "G", control_file="R_MMIS_CONTROL.csv")


def landing(folder):
    folder.mkdir()
    for day, row in (("20250718", "1,a"), ("20250719", "2,b")):
        (folder / f"R_MMIS_X_{day}.csv").write_text(f"id,v\n{row}\n")
    (folder / "P_MMIS_Y.csv").write_text("id\n9\n")
    for owner in ("R", "P"):
        with zipfile.ZipFile(folder / f"{owner}_MMIS_all.zip", "w") as z:
            z.writestr("R_MMIS_X_20250720.csv", f"v,id\n{owner},3\n")
            z.writestr("readme.pdf", bytes(range(256)))
    (folder / "R_MMIS_CONTROL.csv").write_text("TABLE_NAME,ROW_COUNT\nR_MMIS_X,3\n")
    return str(folder)


def test_files_of_one_name_all_load_and_foreign_ones_do_not(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    done = jobs.program_job(lake, landing(tmp_path / "in"), CONFIG, AT)
    assert done["rows"] == {"R_MMIS_X": 3}
    rows = lake.bronze("R_MMIS_X").read(1).select("id", "v").collect()
    assert sorted(map(tuple, rows)) == [("1", "a"), ("2", "b"), ("3", "R")]
    assert not lake.bronze("P_MMIS_Y").exists()


def test_a_failed_file_takes_the_batch_back(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    folder = tmp_path / "in"
    path = landing(folder)
    (folder / "R_MMIS_Z.csv").write_text("id\n1\n")
    (folder / "R_MMIS_CONTROL.csv").write_text("TABLE_NAME,ROW_COUNT\nR_MMIS_X,3\nR_MMIS_Z,1\n")
    config = s.ProgramConfig("MEDICAID", "RECIPIENT", s.FileCriteria(prefix=s.Criterion(("R_MMIS",), 5)), "G", control_file="R_MMIS_CONTROL.csv")
    real = tables.BatchTable.replace

    def replace(self, df, batch_id=None):
        if self.path.endswith("R_MMIS_Z"):
            raise RuntimeError("disk")
        real(self, df, batch_id)

    monkeypatch.setattr(tables.BatchTable, "replace", replace)
    with pytest.raises(RuntimeError):
        jobs.program_job(lake, path, config, AT)
    assert not lake.bronze("R_MMIS_X").exists() or lake.bronze("R_MMIS_X").read(1).count() == 0


def test_rules_of_absent_tables_fail_the_job(spark):
    df = spark.range(3).withColumn("v", F.lit("x"))
    with pytest.raises(KeyError, match="gone"):
        run_rules({"t": df}, [Rule("a", "G", 1, "gone", expression="id > 1")])
    got = {r.rule_id: (r.status, r.n_rows, r.n_failed) for r in run_rules({"t": df}, [
        Rule("ok", "G", 1, "t", expression="id < 2"),
        Rule("zero", "G", 1, "t", expression="10 / (id - 1) > 0"),
        Rule("sum", "G", 1, "t", expression="sum(id) > 0"),
        Rule("twice", "G", 1, "t", "duplicate", keys=("v",)),
    ]).collect()}
    assert got == {"ok": ("FAILED", 3, 1), "zero": ("SYNTAX", 3, 0), "sum": ("SYNTAX", 3, 0), "twice": ("FAILED", 3, 2)}


def test_claims_with_quoted_breaks(spark, tmp_path):
    (tmp_path / "CLAIMS_q.csv").write_text('a,b\n"x\ny",1\n2,3\n')
    (tmp_path / "meta.csv").write_text('FILE_NAME,COLUMNS\nCLAIMS_q.csv,"a,b"\n')
    done = jobs.claims_job(spark, [str(tmp_path / "CLAIMS_q.csv")], str(tmp_path / "meta.csv"), str(tmp_path / "pq"))
    assert done["passed"] == ["CLAIMS_q.csv"]
    assert sorted(map(tuple, spark.table("CLAIMS_q").collect())) == [("2", "3"), ("x\ny", "1")]
    tables.drop_if_exists(spark, "CLAIMS_q")
    with pytest.raises(ValueError, match="one name"):
        jobs.claims_job(spark, ["/a/CLAIMS_q.csv", "/b/CLAIMS_q.csv"], "m", "p")


def test_typed_load_keeps_rejects(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,v\n1,a\n2,b,c\n \n3,"q\nr"\n')
    assert loads.load_csv(spark, str(path), "typed_rows") == 2
    assert [r["_REJECTED"] for r in spark.table("typed_rows_REJECTS").collect()] == ["2,b,c"]
    assert delimited.csv_inferred(spark, str(path)).count() == 2 == len(delimited.csv_inferred(spark, str(path)).collect())
    path.write_text("id,v\n1,a\n")
    assert loads.load_csv(spark, str(path), "typed_rows") == 1
    assert not tables.table_exists(spark, "typed_rows_REJECTS")
    tables.drop_if_exists(spark, "typed_rows")


def test_extraction_leaves_nothing_of_an_earlier_one(spark, tmp_path):
    archives, out = tmp_path / "z", str(tmp_path / "out")
    archives.mkdir()
    for name in ("a.csv", "b.csv"):
        with zipfile.ZipFile(archives / "x.zip", "w") as z:
            z.writestr(name, "id\n1\n")
        files.extract_archives(spark, str(archives), out)
    found = [r["path"] for r in files.file_inventory(spark, out, "*.txt").collect()]
    assert len(found) == 1 and "file_name=b.csv" in found[0]


def test_empty_batch_replaces(spark, tmp_path):
    table, stamp = tables.BatchTable(spark, str(tmp_path / "t")), BatchStamp("P", "S", 4, AT)
    rows = stamp.put_on(spark.range(3))
    table.replace(rows, 4)
    table.replace(rows.where("false"), 4)
    table.replace(BatchStamp("P", "S", 5, AT).put_on(spark.range(1)), 5)
    assert table.read(4).count() == 0 and table.read().count() == 1


def test_local_folder_only_for_a_local_master():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_sql_pieces():
    assert sqltext.statements(r"select 'it\'s; x' as a; select 1") == [r"select 'it\'s; x' as a", "select 1"]
    assert sqltext.statements("select 'a''; b'; -- end;\n") == ["select 'a''; b'"]


def test_wide_bronze_is_read_in_batches(spark, tmp_path):
    wide = spark.range(2).select(*[F.lit("x").alias(f"c{i}") for i in range(337)])
    wide.write.parquet(str(tmp_path / "w"))
    shown = io.StringIO()
    with redirect_stdout(shown):
        spark.read.parquet(str(tmp_path / "w")).select(F.md5(F.concat_ws("", *wide.columns))).explain("formatted")
    assert "Batched: true" in shown.getvalue()


def test_every_file_has_its_header_from_the_counting_pass(spark, tmp_path):
    texts = {"a": 'x,"y z"\n1,2\n', "b": '"p\nq",r\n1,2\n', "c": "", "d": "﻿h\n", "e": " \n\nk,l\n1,2\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    profile = delimited.csv_profile(spark, str(tmp_path))
    got = {r["TABLE_NAME"]: r["actual"] for r in delimited.profiled_headers(profile).collect()}
    assert got == {"a": ["x", "y z"], "b": ["p\nq", "r"], "d": ["h"], "e": ["k", "l"]}


def test_gold_outgrows_its_buckets(spark, tmp_path):
    target = s.TargetTable("T_GROWS", ("k",), ("v",))
    gold = tables.GoldTable(spark, str(tmp_path), target, 2)
    from carestrata.plans.gold import upsert

    upsert(gold, spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string"), BatchStamp("P", "S", 1, AT))
    gold.rebucket(5, 1, AT)
    upsert(gold, spark.createDataFrame([("2", "c"), ("3", "d")], "k string, v string"), BatchStamp("P", "S", 2, AT))
    assert gold.head().buckets == 5 and gold.head().version == 3
    assert gold.expire(keep=1) == [1, 2] and gold.expire(keep=1) == []
    assert sorted((r["k"], r["v"]) for r in gold.current().collect()) == [("1", "a"), ("2", "c"), ("3", "d")]
    with pytest.raises(ValueError):
        gold.expire(keep=0)


def test_release_from_archive_to_gold(spark, tmp_path):
    folder, away = tmp_path / "in", tmp_path / "away"
    folder.mkdir()
    header = ",".join(f'"{c.title()}"' for c in s.REGISTRY_COLUMNS)
    for release, npi in (("X_Dissemination_070725_071325_Weekly_V2.zip", "1"), ("X_Dissemination_June_2025_V2.zip", "2")):
        row = ",".join([npi, "1", *[""] * 328])
        with zipfile.ZipFile(folder / release, "w") as z:
            z.writestr("readme.pdf", bytes(range(256)))
            z.writestr("npidata_pfile_20250707-20250713_fileheader.csv", header + "\n")
            z.writestr("othername_pfile_20250707-20250713.csv", "a\n1\n")
            z.writestr("npidata_pfile_20250707-20250713.csv", f"{header}\r\n{row}\r\n")
    lake = jobs.Lake(spark, str(tmp_path / "lake"), buckets=2)
    rules = [Rule("r", s.REGISTRY.rule_group, 1, "GOLD_PROVIDER_NPI", expression="NPI <> '9'")]
    seen = []
    for _ in range(3):
        done = jobs.release_job(lake, str(folder), s.REGISTRY, AT, jobs.registry_job, "npidata_pfile", str(away), rules=rules)
        seen.append((done["status"], done.get("release", "")[:19]))
    assert seen == [("completed", "X_Dissemination_070"), ("completed", "X_Dissemination_Jun"), ("no_new_release", "")]
    assert sorted(r["NPI"] for r in lake.gold(s.PROVIDER_TABLES["PROVIDER_NPI"]).current().collect()) == ["1", "2"]
    assert lake.run_log.read().count() == 2 and len(list(away.glob("*.zip"))) == 2
    assert lake.lineage.read().where("CHILD_ID_TRANSACTION is not null").count() == 8
