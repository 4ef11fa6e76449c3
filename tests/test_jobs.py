import csv
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from carestrata import settings as s
from carestrata.operators.merge import BatchStamp
from carestrata.operators.rules import Rule
from carestrata.operators.validate import ValidationFailed
from carestrata.plans import jobs, loads, silver, sqltext, tables
from carestrata.sources.delimited import HeaderMismatch
from carestrata.streaming.ingest import ingest_and_wait, new_files

AT = datetime(2024, 1, 1)


def registry_file(path, providers):
    """Registry CSV; each provider is a dict of target columns."""
    with open(path, "w", newline="") as f:
        writer = csv.writer(f, quoting=csv.QUOTE_ALL)
        writer.writerow([c.replace("_", " ").title() for c in s.REGISTRY_COLUMNS])
        writer.writerows([[p.get(c, "") for c in s.REGISTRY_COLUMNS] for p in providers])
    return str(path)


DOE = {
    "NPI": "1", "ENTITY_TYPE_CODE": "1", "PROVIDER_LAST_NAME": "Doe", "PROVIDER_FIRST_NAME": "Jo", "PROVIDER_MIDDLE_NAME": "K",
    s.MAILING_ADDRESS[0]: "1 Main\nFloor 2", s.MAILING_ADDRESS[3]: "New York", s.MAILING_ADDRESS[4]: "12345-6789",
    s.MAILING_ADDRESS[6]: "(212) 555-1234", s.PRACTICE_ADDRESS[0]: "2 Side", s.PRACTICE_ADDRESS[3]: "NY",
    "HEALTHCARE_PROVIDER_TAXONOMY_CODE_1": "T1", "HEALTHCARE_PROVIDER_TAXONOMY_GROUP_1": "G1",
    "HEALTHCARE_PROVIDER_TAXONOMY_CODE_15": "T15", "PROVIDER_LICENSE_NUMBER_15": "L15",
    "OTHER_PROVIDER_IDENTIFIER_50": "I50", "OTHER_PROVIDER_IDENTIFIER_ISSUER_50": "X", "NPI_DEACTIVATION_DATE": "2020-01-01",
}
ACME = {"NPI": "2", "ENTITY_TYPE_CODE": "2", "PROVIDER_ORGANIZATION_NAME": "Acme", "AUTHORIZED_OFFICIAL_TELEPHONE_NUMBER": "123"}


def test_registry_columns():
    assert len(s.REGISTRY_COLUMNS) == 330 == len(set(s.REGISTRY_COLUMNS))
    assert [len(t.business) for t in s.PROVIDER_TABLES.values()] == [46, 9, 5, 4, 4]
    assert s.REGISTRY_COLUMNS[314] == "HEALTHCARE_PROVIDER_TAXONOMY_GROUP_1"


def test_registry_job(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), buckets=2)
    nameless = {"ENTITY_TYPE_CODE": "2", "PROVIDER_ORGANIZATION_NAME": "no key"}
    first = jobs.registry_job(lake, registry_file(tmp_path / "a.csv", [DOE, ACME, nameless]), s.REGISTRY, AT)
    assert {k: v["gold_total"] for k, v in first["gold"].items()} == {
        "PROVIDER_NPI": 2, "PROVIDER_NPI_ADDRESS": 2, "PROVIDER_NPI_TAXONOMY": 2, "PROVIDER_NPI_OTHER_IDS": 1, "PROVIDER_NPI_XREF": 2,
    }
    gold = {n: lake.gold(t).current() for n, t in s.PROVIDER_TABLES.items()}
    doe = gold["PROVIDER_NPI"].where("NPI = '1'").first()
    assert doe["PROVIDER_ORGANIZATION_NAME"] == "Doe, Jo K" and doe[s.MAILING_ADDRESS[6]] == "(212) 555-1234"
    assert gold["PROVIDER_NPI"].where("NPI = '2'").first()["AUTHORIZED_OFFICIAL_TELEPHONE_NUMBER"] is None
    address = {r["PROVIDER_ADDRESS_TYPE"]: r for r in gold["PROVIDER_NPI_ADDRESS"].collect()}
    assert address["M"][s.ADDRESS_COLUMNS[0]] == "1 Main\nFloor 2"
    assert [address["M"][c] for c in s.ADDRESS_COLUMNS[3:6]] == [None, "12345", "6789"]
    assert address["S"][s.ADDRESS_COLUMNS[3]] == "NY"
    taxonomy = {r["HEALTHCARE_PROVIDER_TAXONOMY_CODE_SEQ_ID"]: tuple(r)[8:] for r in gold["PROVIDER_NPI_TAXONOMY"].collect()}
    assert taxonomy == {"1": ("T1", "G1", None, None, None), "15": ("T15", None, "L15", None, None)}
    ids = gold["PROVIDER_NPI_OTHER_IDS"].first()
    assert (ids["OTHER_PROVIDER_IDENTIFIER_SEQ_ID"], ids["OTHER_PROVIDER_IDENTIFIER_ISSUER"]) == ("50", "X")
    assert {r["NPI"]: r["IS_NPI_ACTIVE"] for r in gold["PROVIDER_NPI_XREF"].collect()} == {"1": "N", "2": "Y"}

    changed = {**DOE, "PROVIDER_FIRST_NAME": "Al"}
    path = registry_file(tmp_path / "b.csv", [changed, ACME, {"NPI": "3"}])
    second = jobs.registry_job(lake, path, s.REGISTRY, AT)["gold"]
    assert second["PROVIDER_NPI"] == {"inserted": 1, "updated": 1, "gold_total": 3}
    assert jobs.registry_job(lake, path, s.REGISTRY, AT)["gold"]["PROVIDER_NPI"] == {"inserted": 0, "updated": 0, "gold_total": 3}
    states = {(r["ID_BATCH"], r["CODE_LOAD_STATUS"]) for r in lake.audit.read().collect()}
    assert states == {(b, st) for b in "123" for st in ("IN_PROGRESS", "COMPLETED")}


def test_failures_are_audited_and_change_nothing(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), buckets=2)
    with pytest.raises(HeaderMismatch):
        jobs.registry_job(lake, registry_file(tmp_path / "a.csv", [DOE]), s.REGISTRY, AT, names=["NPI"])
    assert lake.gold(s.PROVIDER_TABLES["PROVIDER_NPI"]).head().version == 0
    rule = [Rule("r", s.REGISTRY.rule_group, 0, s.REGISTRY.bronze_table, expression="NPI <> '1'")]
    with pytest.raises(jobs.RulesFailed, match="SEV_0"):
        jobs.registry_job(lake, registry_file(tmp_path / "b.csv", [DOE]), s.REGISTRY, AT, rules=rule)
    empty = jobs.registry_job(lake, registry_file(tmp_path / "c.csv", []), s.REGISTRY, AT)
    assert empty["status"] == "no_data"
    states = [(r["ID_BATCH"], r["CODE_LOAD_STATUS"]) for r in lake.audit.read().where("CODE_LOAD_STATUS <> 'IN_PROGRESS'").collect()]
    assert sorted(states) == [("1", "FAILED"), ("2", "FAILED"), ("3", "COMPLETED")]


def test_first_file_without_records(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), buckets=2)
    assert jobs.registry_job(lake, registry_file(tmp_path / "a.csv", []), s.REGISTRY, AT)["status"] == "no_data"
    landing = program_landing(tmp_path / "in", "R_MMIS_A,2\nR_MMIS_B,0\n")
    (tmp_path / "in" / "R_MMIS_B.csv").write_text("id\n")
    rule = [Rule("r", "G", 0, "R_MMIS_B", expression="id > '0'")]
    assert jobs.program_job(lake, landing, PROGRAM, AT, rules=rule)["rows"] == {"R_MMIS_A": 2, "R_MMIS_B": 0}


def test_code_set_job(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), buckets=2)
    path = tmp_path / "nucc_taxonomy_251.csv"
    path.write_text('Code,Grouping,Classification,Specialization,Definition,Notes,Display Name,Section\nA,g,c,s,"d\ne",n,  ,x\nB,g,c,s,d,n,Bee,x\n')
    assert jobs.code_set_job(lake, str(path), s.CODE_SET, AT)["gold"]["NUCC_TAXONOMY"]["inserted"] == 2
    rows = {r["CODE"]: r["DISPLAY_NAME"] for r in lake.gold(s.CODE_SET_TABLE).current().collect()}
    assert rows == {"A": "DESCRIPTION NOT AVAILABLE", "B": "Bee"}


def program_landing(folder, control="R_MMIS_A,2\nR_MMIS_B,1\n"):
    folder.mkdir()
    with zipfile.ZipFile(folder / "R_MMIS_all.zip", "w") as z:
        z.writestr("sub/", "")
        z.writestr("sub/R_MMIS_A_20240101.csv", 'id,v\n1,"x\ny"\n2,z\n')
    (folder / "R_MMIS_B.csv").write_text("id\n9\n")
    (folder / "R_MMIS_CONTROL.csv").write_text("TABLE_NAME,ROW_COUNT\n" + control)
    return str(folder)


PROGRAM = s.ProgramConfig("MEDICAID", "RECIPIENT", s.FileCriteria(prefix=s.Criterion(("R_MMIS",), 3)), "G", control_file="R_MMIS_CONTROL.csv")


def schema_registry(spark, *fields):
    return spark.createDataFrame([(o, f, i) for i, (o, f) in enumerate(fields)], "OBJECT_NAME string, FIELD_NAME string, ID_OBJECT long")


def test_program_job(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    registry = schema_registry(spark, ("R_MMIS_A", "id"), ("R_MMIS_A", "v"), ("R_MMIS_B", "id"))
    rule = [Rule("r", "G", 1, "R_MMIS_A", expression="v <> 'z'")]
    done = jobs.program_job(lake, program_landing(tmp_path / "in"), PROGRAM, AT, registry, rule)
    assert done == {"status": "completed", "batch_id": 1, "rows": {"R_MMIS_A": 2, "R_MMIS_B": 1}}
    a = lake.bronze("R_MMIS_A").read(1)
    assert sorted((r["id"], r["v"]) for r in a.collect()) == [("1", "x\ny"), ("2", "z")]
    assert {r["META_SUBJECT_AREA"] for r in a.collect()} == {"RECIPIENT"} and "META_ROW_ID" in a.columns
    assert lake.lineage.read().count() == 4 and lake.control.read().count() == 2
    logged = lake.run_log.read().first()
    assert (logged["N_FAILED_SEVERITY_1"], logged["N_FAILED_SEVERITY_0"]) == (1, 0)


def test_program_job_stops_at_each_gate(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    landing = program_landing(tmp_path / "in", "R_MMIS_A,3\nR_MMIS_B,1\nR_MMIS_C,1\n")
    more = s.ProgramConfig("MEDICAID", "RECIPIENT", s.FileCriteria(prefix=s.Criterion(("R_MMIS",), 9)), "G")
    with pytest.raises(jobs.NotReady, match="INCOMPLETE, 3/9"):
        jobs.program_job(lake, landing, more, AT)
    with pytest.raises(ValidationFailed, match="failed for 2"):
        jobs.program_job(lake, landing, PROGRAM, AT)
    good = program_landing(tmp_path / "in2")
    with pytest.raises(ValidationFailed, match="Schema"):
        jobs.program_job(lake, good, PROGRAM, AT, schema_registry(spark, ("R_MMIS_A", "v"), ("R_MMIS_A", "id"), ("R_MMIS_B", "id")))
    assert not lake.bronze("R_MMIS_A").exists()


def test_claims_job(spark, tmp_path):
    for name, text in {"CLAIMS_x": "a,b\n01,2\n", "CLAIMS_y": "a,c\n1,2\n", "CLAIMS_z": "a\n1\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    (tmp_path / "meta.csv").write_text('FILE_NAME,COLUMNS\nCLAIMS_x.csv,"a,b"\nCLAIMS_y.csv,"a,b"\n')
    files = [str(tmp_path / f"CLAIMS_{n}.csv") for n in "xyz"]
    for _ in range(2):
        done = jobs.claims_job(spark, files, str(tmp_path / "meta.csv"), str(tmp_path / "pq"))
        assert done == {"passed": ["CLAIMS_x.csv"], "failed": ["CLAIMS_y.csv", "CLAIMS_z.csv"]}
        assert [tuple(r) for r in spark.table("CLAIMS_x").collect()] == [("01", "2")]
    tables.drop_if_exists(spark, "CLAIMS_x")


def test_rating_job_and_catalog_helpers(spark):
    spark.createDataFrame([("NY", "a", 4.0), (None, "b", 1.0), ("NJ", "c", None)], "STATE string, COFFEE_SHOP string, RATING double").createOrReplaceTempView("shops")
    got = jobs.rating_job(spark, "shops", "rated", AT)
    assert [(r["COFFEE_SHOP"], r["RATING_CATEGORY"]) for r in got.collect()] == [("a", "Excellent")]
    assert tables.table_exists(spark, "rated") and not tables.table_exists(spark, "nothing_here")
    assert tables.create_if_absent(spark, "fresh", ["x", "y"]) and not tables.create_if_absent(spark, "fresh", ["x"])
    tables.clone_schema_then_insert(spark, "fresh", "cloned", spark.createDataFrame([(1, 2)], "y int, x int"))
    assert spark.table("cloned").first().asDict() == {"x": "2", "y": "1"}
    for name in ("rated", "fresh", "cloned"):
        tables.drop_if_exists(spark, name)
    assert not tables.table_exists(spark, "rated")


def test_sql_text(spark):
    text = "SELECT ';' AS a; -- x; y\n/* ; */ SELECT \"q\" ;;\n SELECT 'it''s; ' AS b -- end"
    assert sqltext.statements(text) == ["SELECT ';' AS a", "-- x; y\n/* ; */ SELECT \"q\"", "SELECT 'it''s; ' AS b -- end"]
    spark.range(5).createOrReplaceTempView("numbers")
    script = "CREATE OR REPLACE TABLE {{target}} AS SELECT id, '{who}' AS who FROM {{source}} WHERE id < {top};"
    out = sqltext.run_sql(spark, script, {"target": "few", "source": "numbers"}, {"who": "O'N", "top": 2})
    assert sorted(map(tuple, out.collect())) == [(0, "O'N"), (1, "O'N")]
    again = sqltext.run_sql(spark, script, {"target": "few", "source": "numbers"}, {"who": "x", "top": 1})
    assert again.count() == 1
    tables.drop_if_exists(spark, "few")
    with pytest.raises(ValueError, match="object name"):
        sqltext.bind("{{t}}", {"t": "a; DROP TABLE b"}, {})
    with pytest.raises(KeyError):
        sqltext.bind("{t}", {}, {})


def test_replace_batch_is_idempotent(spark, tmp_path):
    table = tables.BatchTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, META_BATCH_ID long")
    table.replace(rows)
    for _ in range(2):
        table.replace(spark.createDataFrame([("c", 2)], "k string, META_BATCH_ID long"))
    assert sorted((r["k"], r["META_BATCH_ID"]) for r in table.read().collect()) == [("a", 1), ("c", 2)]
    assert table.read(1).count() == 1 and table.exists()


def test_unpivot_reads_bronze_once_and_prunes(spark, tmp_path):
    bronze = tables.BatchTable(spark, str(tmp_path / "bronze"))
    stamp = BatchStamp("P", "S", 5, AT)
    row = spark.createDataFrame([tuple("x" for _ in s.REGISTRY_COLUMNS)], ", ".join(f"{c} string" for c in s.REGISTRY_COLUMNS))
    bronze.replace(stamp.put_on(row))
    for name in s.PROVIDER_TABLES:
        plan = silver.build(name, bronze.read(5), stamp)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1, name
        assert "Batched: true" in plan and "PartitionFilters: [isnotnull(META_BATCH_ID" in plan, name
        assert "Exchange" not in plan, name
    assert silver.build("PROVIDER_NPI_OTHER_IDS", bronze.read(5), stamp).count() == 50


def test_table_loads(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("CLAIMS_p.parquet", "OTHER.parquet")]
    for path in paths:
        spark.createDataFrame([(1, "x")], "id int, Name string").write.parquet(path)
    narrow = str(tmp_path / "narrow.parquet")
    spark.createDataFrame([(2,)], "ID int").write.parquet(narrow)
    assert loads.load_parquet(spark, paths[0], "pq") == 1 and loads.load_parquet(spark, narrow, "pq") == 2
    assert sorted(map(tuple, spark.table("pq").collect())) == [(1, "x"), (2, None)]
    assert loads.load_parquet(spark, narrow, "pq", "replace") == 1 and spark.table("pq").columns == ["ID", "NAME"]
    assert loads.load_each(spark, paths, "CLAIMS_", stamp=BatchStamp("P", "S", 1, AT)) == {"CLAIMS_p": 1}
    assert loads.load_each(spark, paths, "CLAIMS_", stamp=BatchStamp("P", "S", 2, AT)) == {"CLAIMS_p": 2}
    assert loads.create_each(spark, paths, "_T", AT) == {"CLAIMS_p_T": 1, "OTHER_T": 1}
    assert "CLAIMS_p.parquet" in spark.table("CLAIMS_p_T").first()["_source_file"]
    (tmp_path / "a.csv").write_text("n\n1\n2\n")
    assert [loads.load_csv(spark, str(tmp_path / "a.csv"), "typed", m) for m in ("replace", "append", "replace")] == [2, 4, 2]
    for name in ("pq", "CLAIMS_p", "CLAIMS_p_T", "OTHER_T", "typed"):
        tables.drop_if_exists(spark, name)


def test_batch_is_taken_out(spark, tmp_path):
    table = tables.BatchTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([("a", 1), ("b", 2)], "k string, META_BATCH_ID long"))
    assert table.drop_batch(2) and not table.drop_batch(2)
    assert [r["k"] for r in table.read().collect()] == ["a"]


def test_failed_silver_leaves_no_batch(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), buckets=2)

    def broken(bronze):
        raise RuntimeError("boom")

    monkeypatch.setitem(silver.PROVIDER_BUILDS, "PROVIDER_NPI_XREF", broken)
    with pytest.raises(RuntimeError, match="boom"):
        jobs.registry_job(lake, registry_file(tmp_path / "a.csv", [DOE]), s.REGISTRY, AT)
    left = [p for p in (tmp_path / "lake" / "silver").rglob("*.parquet")]
    assert left == [] and lake.gold(s.PROVIDER_TABLES["PROVIDER_NPI"]).head().version == 0


def test_ingest_takes_each_file_once(spark, tmp_path):
    landing, bronze, memory = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "memory")
    landing.mkdir()

    def run(batch):
        stream = new_files(spark, str(landing), ["id", "v"], glob="*.csv", files_per_trigger=1)
        return ingest_and_wait(stream, bronze, memory, BatchStamp("P", "S", batch, AT))

    (landing / "a.csv").write_text('K,V\n1,"x,y"\n2,z\n')
    (landing / "b.csv").write_text("K,V\n3,q\n")
    (landing / "skip.txt").write_text("K,V\n4,q\n")
    assert run(1) == 3 and run(2) == 0
    (landing / "late.csv").write_text("K,V\n5,q\n")
    assert run(3) == 1
    got = spark.read.parquet(bronze)
    assert sorted((r["id"], r["v"], r["META_BATCH_ID"]) for r in got.collect()) == [("1", "x,y", 1), ("2", "z", 1), ("3", "q", 1), ("5", "q", 3)]
    assert got.where(F.col("META_SOURCE_FILE").endswith("late.csv")).count() == 1


def test_interrupted_ingest_is_repeated_without_copies(spark, tmp_path):
    landing, bronze, memory = tmp_path / "in", str(tmp_path / "bronze"), tmp_path / "memory"
    landing.mkdir()
    (landing / "a.csv").write_text("K\n1\n2\n")

    def run():
        stream = new_files(spark, str(landing), ["id"])
        return ingest_and_wait(stream, bronze, str(memory), BatchStamp("P", "S", 1, AT))

    assert run() == 2
    # as if the process had died after writing but before the micro-batch was marked done
    for mark in (memory / "commits").glob("*"):
        mark.unlink()
    for mark in (memory / "commits").glob(".*"):
        mark.unlink()
    assert run() == 2
    assert sorted(r["id"] for r in spark.read.parquet(bronze).collect()) == ["1", "2"]


def test_consumed_files_are_archived_later(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for n, name in enumerate("abc", 1):
        (landing / f"{name}.csv").write_text(f"K\n{n}\n")
        stream = new_files(spark, str(landing), ["id"], clean="archive", archive=str(tmp_path / "archive"))
        ingest_and_wait(stream, str(tmp_path / "bronze"), str(tmp_path / "memory"), BatchStamp("P", "S", n, AT))
    assert {p.name for p in (tmp_path / "archive").rglob("*.csv")} <= {"a.csv", "b.csv"}
    assert (landing / "c.csv").exists()
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 3
