import random
import re
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carestrata.operators import audit, fileset, ordinals, predicates, rules, skew, validate
from carestrata.operators.lineage import lineage_rows
from carestrata.settings import Criterion, FileCriteria


def matches(name, spec, ci=True):
    """Plain statement of the six-way file predicate."""
    low = name.lower()
    tests = {
        "prefix": lambda p: name.startswith(p),
        "suffix": lambda p: name.endswith(p),
        "contains": lambda p: p in name,
        "regex": lambda p: re.search(p, name) is not None,
        "extension": lambda p: low.endswith(p.lower()) if ci else name.endswith(p),
    }
    for kind, patterns in spec.items():
        if not patterns:
            continue
        if kind == "not_contains":
            if any(p in name for p in patterns):
                return False
        elif not any(tests[kind](p) for p in patterns):
            return False
    return True


@pytest.mark.parametrize("ci", [True, False])
def test_file_predicate_equals_model(spark, ci):
    rng = random.Random(3)
    names = ["".join(rng.choice(["R_", "P_", "a", "1", "_TB", ".csv", ".CSV", "x"]) for _ in range(rng.randint(1, 6))) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "name string")
    pool = {"prefix": ["R_", "P_"], "suffix": ["csv", "x"], "contains": ["1", "_T"], "not_contains": ["aa", "xx"],
            "regex": [r"\d", "^R.*_TB"], "extension": [".csv", ".Csv"]}
    for _ in range(12):
        spec = {k: tuple(rng.sample(v, rng.randint(0, 2))) for k, v in pool.items() if rng.random() < 0.5}
        criteria = FileCriteria(**{k: Criterion(v) for k, v in spec.items()})
        got = {r["name"] for r in df.where(predicates.file_matches(criteria, F.col("name"), ci)).collect()}
        assert got == {n for n in names if matches(n, spec, ci)}


def test_criteria_from_dict():
    spec = {"prefix": {"pattern": ["A"], "count": 9}, "suffix": {"pattern": None, "count": 0},
            "contains": {"pattern": "x", "count": 2}, "extension": {"pattern": [".csv"], "count": 1}}
    criteria = FileCriteria.from_dict(spec)
    assert criteria.expected_total == 11 and criteria.contains.patterns == ("x",)


@pytest.mark.parametrize(
    "names, told, state, found",
    [
        (["A1.csv", "A2.csv"], False, "COMPLETE", 2),
        (["A1.csv", "A2.csv"], True, "COMPLETE_NOTIFIED", 2),
        (["A1.csv"], False, "INCOMPLETE", 1),
        (["A1.csv", "A2.csv", "A3.csv"], False, "EXCESS_FILES", 3),
        (["A1.csv", "A2.CSV"], False, "INCOMPLETE", 1),
        ([], False, "INCOMPLETE", 0),
    ],
)
def test_completeness(spark, names, told, state, found):
    criteria = FileCriteria(prefix=Criterion(("A",), 2), extension=Criterion((".csv",), 1))
    df = spark.createDataFrame([(n,) for n in names], "name string")
    row = fileset.set_completeness(df, criteria, notified=F.lit(told)).first()
    assert (row["state"], row["found_total"]) == (state, found)


def test_criteria_not_met(spark):
    criteria = FileCriteria(prefix=Criterion(("A",), 1), suffix=Criterion(("z",), 1))
    df = spark.createDataFrame([("A1",), ("A2",)], "name string")
    assert fileset.set_completeness(df, criteria).first()["state"] == "CRITERIA_NOT_MET"
    both = spark.createDataFrame([("Az",)], "name string")
    assert fileset.set_completeness(both, criteria).first()["found_total"] == 2
    assert [r["name"] for r in fileset.matched_files(df, criteria).orderBy("name").collect()] == ["A1", "A2"]


def test_sets_fire_once_per_count(spark):
    states = spark.createDataFrame([("a", 3, True), ("b", 3, True), ("c", 2, False)], "set string, found_total long, complete boolean")
    fired = spark.createDataFrame([("a", 3), ("b", 2)], "set string, found_total long")
    assert [r["set"] for r in fileset.due_sets(states, fired, "set").collect()] == ["b"]


def test_may_start():
    def state(complete, found, expected):
        return {"complete": complete, "found_total": found, "expected_total": expected, "enough": found >= expected}

    assert audit.may_start(state(True, 2, 2))
    assert not audit.may_start(state(True, 3, 2))
    assert audit.may_start(state(False, 3, 2), at_least=True)
    assert not audit.may_start(state(False, 1, 2), at_least=True)


def test_step_gate():
    assert audit.run_if_completed({"status": "completed"}, lambda: {"status": "ran"}) == {"status": "ran"}
    assert audit.run_if_completed({"status": "failed"}, lambda: 1 / 0)["status"] == "skipped"


def test_next_batch_id(spark):
    at = datetime(2024, 1, 1)
    rows = [("7", "P", "S", "COMPLETED", at, "E"), ("x9", "P", "S", "FAILED", at, "E"), ("99", "P", "S", "CANCELLED", at, "E"),
            ("50", "P", "T", "COMPLETED", at, "E"), ("-5", "Q", "S", "FAILED", at, "E")]
    df = spark.createDataFrame(rows, audit.AUDIT_SCHEMA)
    assert [audit.next_batch_id(df, *k) for k in (("P", "S"), ("P", "T"), ("Q", "S"), ("Q", "T"))] == [8, 51, 1, 1]


def test_row_counts(spark):
    control = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("x", 1)], "TABLE_NAME string, ROW_COUNT long")
    counts = spark.createDataFrame([("a", 1), ("b", 5), ("d", 9)], "TABLE_NAME string, actual_rows long")
    result = validate.check_row_counts(control, counts, FileCriteria(not_contains=Criterion(("x",))))
    got = {r["table_name"]: (r["status"], r["error"]) for r in result.collect()}
    assert got == {"a": ("PASSED", None), "b": ("FAILED", "Row count mismatch: expected 2, got 5"),
                   "c": ("FAILED", "File not found"), "x": ("FILTERED", None)}
    assert validate.tally(result).first().asDict() == {"passed": 1, "failed": 2, "filtered_out": 1}
    with pytest.raises(validate.ValidationFailed, match="failed for 2"):
        validate.require_passed(result, "Counts", "table_name")
    validate.require_passed(validate.check_row_counts(control.limit(0), counts), "Counts", "table_name")


def test_schemas(spark):
    registry = spark.createDataFrame([("t", "b", 2), ("t", "a", 1), ("t", "c", 10)], "OBJECT_NAME string, FIELD_NAME string, ID_OBJECT long")
    headers = spark.createDataFrame([("t", ["a", "b", "c"]), ("u", ["a"])], "object_name string, actual array<string>")
    swapped = spark.createDataFrame([("t", ["b", "a", "x"])], "object_name string, actual array<string>")
    got = {r["object_name"]: r for r in validate.check_schemas(headers, registry).collect()}
    assert got["t"]["status"] == "PASSED" and got["u"]["error"] == "No schema definition found"
    bad = validate.check_schemas(swapped, registry).first()
    assert (bad["status"], bad["missing_columns"], bad["extra_columns"], bad["expected_columns"]) == ("FAILED", ["c"], ["x"], 3)


RULES = [
    rules.Rule("1", "G", 0, "t", expression="v > 0"),
    rules.Rule("2", "G", 1, "t", kind="null", expression="k"),
    rules.Rule("3", "G", 2, "t", kind="duplicate", keys=("k",)),
    rules.Rule("4", "G", 3, "t", expression="broken ((" ),
    rules.Rule("5", "H", 3, "t", expression="true"),
    rules.Rule("6", "H", 1, "t", kind="duplicate", keys=("nope",)),
]


def test_rules(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, -1), ("b", 2)], "k string, v int")
    got = {r["rule_id"]: (r["n_rows"], r["n_failed"], r["status"]) for r in rules.run_rules({"t": df}, RULES).collect()}
    assert got == {"1": (4, 2, "FAILED"), "2": (4, 1, "FAILED"), "3": (4, 1, "FAILED"), "4": (4, 0, "SYNTAX"),
                   "5": (4, 0, "PASSED"), "6": (4, 0, "SYNTAX")}
    only = rules.run_rules({"t": df}, RULES, "G", "2").collect()
    assert [r["rule_id"] for r in only] == ["2"]
    with pytest.raises(ValueError):
        rules.run_rules({"t": df}, RULES, "G", "5")


def test_rules_on_an_empty_table(spark):
    got = rules.run_rules({"t": spark.createDataFrame([], "k string, v int")}, RULES).collect()
    assert {r["rule_id"]: r["status"] for r in got} == {"1": "PASSED", "2": "PASSED", "3": "PASSED", "4": "SYNTAX", "5": "PASSED", "6": "SYNTAX"}


def log(spark, **n):
    counts = {"N_FAILED_SYNTAX_COUNT": 0, **{f"N_FAILED_SEVERITY_{s}": 0 for s in range(4)}, **n}
    ddl = "RULE_GROUP string, ID_BATCH string, DATE_METRIC string, " + ", ".join(f"{c} long" for c in counts)
    return spark.createDataFrame([("G", "1", "2024-01-01", *counts.values())], ddl)


@pytest.mark.parametrize(
    "counts, alerts, code",
    [
        ({}, ["SUCCESS/regular/Informational"], 0),
        ({"N_FAILED_SYNTAX_COUNT": 1, "N_FAILED_SEVERITY_0": 2}, ["SYNTAX/oncall/High"], 3),
        ({"N_FAILED_SEVERITY_0": 2, "N_FAILED_SEVERITY_1": 1}, ["SEV_0/oncall/High", "SEV_0/regular/High"], 2),
        ({"N_FAILED_SEVERITY_1": 1}, ["SEV_1/oncall/High", "SEV_1/regular/Medium", "SUCCESS/regular/Informational"], 1),
        ({"N_FAILED_SEVERITY_2": 1, "N_FAILED_SEVERITY_3": 1},
         ["SEV_2/regular/Medium", "SEV_3/regular/Medium", "SUCCESS/regular/Informational"], 1),
    ],
)
def test_alert_routing(spark, counts, alerts, code):
    df = log(spark, **counts)
    assert sorted(f"{r['cause']}/{r['alert_type']}/{r['severity']}" for r in rules.route_alerts(df).collect()) == alerts
    parsed = rules.parse_status(rules.status_document(df)).first()["status"]
    assert (parsed["status_code"], parsed["batch_info"]["batch_id"]) == (code, "1")


@pytest.mark.parametrize("n, per_range", [(0, 4), (1, 4), (500, 1), (500, 16), (500, 600)])
def test_row_numbers_have_no_gaps(spark, n, per_range):
    names = [f"dir/{i:04d}" if i % 3 else f"z{i}" for i in range(n)]
    df = spark.createDataFrame([(x,) for x in names], "p string")
    got = {r["p"]: r["n"] for r in ordinals.number_rows(df, "p", "n", per_range).collect()}
    assert got == {x: i for i, x in enumerate(sorted(names), 1)}


def test_salted_join(spark):
    many = spark.range(500).select(F.lit("hot").alias("k"), "id").unionByName(spark.range(5).select(F.lit("cold").alias("k"), "id"))
    one = spark.createDataFrame([("hot", 1), ("cold", 2), ("none", 3)], "k string, v int")
    got = skew.salted_join(many, one, ["k"], F.col("id"))
    assert {r["v"]: r["count"] for r in got.groupBy("v").count().collect()} == {1: 500, 2: 5}


def test_lineage(spark):
    at = datetime(2024, 1, 1)
    files = spark.createDataFrame([("/l/b.zip", "b.zip", 10, at), ("/l/a.csv", "a.csv", None, at)], "path string, name string, size long, modified timestamp")
    members = spark.createDataFrame([("/l/b.zip", 1, "d/", 0), ("/l/b.zip", 2, "d/x.TXT", 5)], "path string, ordinal int, member string, size long")
    got = {(r["ID_TRANSACTION"], r["CHILD_ID_TRANSACTION"]): (r["FILE_NAME"], r["CODE_FILE_TYPE"], r["FILE_SIZE"], r["FILE_PATH_FQN"])
           for r in lineage_rows(files, members, "P", "S", 4, "2024-01-01").collect()}
    assert got == {("P_S_2024-01-01_4_1", None): ("a.csv", "CSV", "UNKNOWN", "/l/a.csv"),
                   ("P_S_2024-01-01_4_2", None): ("b.zip", "ZIP", "10B", "/l/b.zip"),
                   ("P_S_2024-01-01_4_2", "2"): ("x.TXT", "TEXT", "5B", "/l/b.zip/x.TXT")}


def test_ranges_are_even(spark):
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("p"))
    cuts = ordinals.cut_points(df, "p", 1000)
    values = sorted(r["p"] for r in df.collect())
    sizes = np.diff(np.searchsorted(values, ["", *cuts, "g"]))
    assert len(sizes) == 20 and sizes.max() / sizes.mean() < 1.5


def test_fields_of_an_object_are_exchanged_as_one_row(spark):
    batch = pa.RecordBatch.from_pydict({"o": ["a", "a", None, None, "b", "a"], "i": [2, 1, None, 3, 1, 0], "n": ["x", "y,\"", None, "z", "", "\n"]})
    runs = [r for b in validate._in_runs(iter([batch, batch.slice(0, 0), batch.slice(4)])) for r in b.to_pylist()]
    assert [(r["object_name"], r["ids"]) for r in runs] == [("a", [2, 1]), (None, [None, 3]), ("b", [1]), ("a", [0]), ("b", [1]), ("a", [0])]
    rows = [(o, i, n) for o, i, n in zip(*batch.to_pydict().values())]
    rows += [(f"o{i % 300}", i, f"f{i}") for i in range(3000)]
    made = validate.ordered_fields(spark.createDataFrame(rows, "OBJECT_NAME string, ID_OBJECT int, FIELD_NAME string").coalesce(1))
    found = {r["object_name"]: r["expected"] for r in made.collect()}
    assert found.pop("a") == ["\n", "y,\"", "x"] and found.pop(None) == [None, "z"] and found.pop("b") == [""]
    assert found == {f"o{i}": [f"f{j}" for j in range(i, 3000, 300)] for i in range(300)}
