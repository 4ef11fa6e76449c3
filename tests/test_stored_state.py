from collections import Counter
from datetime import datetime, timedelta
from random import Random

import pytest

from carestrata.operators.rules import Rule, run_rules
from carestrata.plans.rule_state import RuleState
from carestrata.plans.tables import BatchTable
from carestrata.settings import Criterion, FileCriteria
from carestrata.streaming import monitor
from carestrata.streaming.monitor import watch_sets

RULES = [
    Rule("p", "G", 0, "t", expression="v > 1"),
    Rule("n", "G", 1, "t", kind="null", expression="k"),
    Rule("d", "G", 2, "t", kind="duplicate", keys=("k",)),
    Rule("w", "G", 2, "t", expression="w = 'x'"),
    Rule("bad", "G", 3, "t", kind="duplicate", keys=("none",)),
]


def same_as_a_full_run(state, kept, rules=RULES):
    got = state.update(kept, rules)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, run_rules({"t": kept.read()}, rules).collect()))


def test_totals_are_those_of_a_full_run(spark, tmp_path):
    kept, state = BatchTable(spark, str(tmp_path / "t")), RuleState(spark, str(tmp_path / "s"))
    ddl = "k string, v int"
    kept.replace(spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], ddl), 1)
    kept.replace(spark.createDataFrame([("a", 5), (None, 1), ("c", 2)], ddl), 2)
    same_as_a_full_run(state, kept)
    lines = state.checked().count()
    same_as_a_full_run(state, kept)
    assert state.checked().count() == lines  # nothing new, nothing checked
    kept.replace(spark.createDataFrame([("c", 5), ("d", 1)], ddl), 1)  # takes a, NULL and b back, as far as batch 2 lacks them
    kept.replace(spark.createDataFrame([("d", 5, "x")], ddl + ", w string"), 3)  # mends the rule on w
    same_as_a_full_run(state, kept)
    kept.drop_batch(2)
    kept.replace(spark.createDataFrame([], ddl), 4)
    same_as_a_full_run(state, kept, [*RULES[:3], Rule("p", "G", 0, "t", expression="v > 4")])  # a rule changed


def test_rules_of_two_tables_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        RuleState(spark, str(tmp_path)).update(BatchTable(spark, str(tmp_path / "t")), [RULES[0], Rule("q", "G", 0, "u", expression="true")])


def test_sets_are_told_once_and_again_after_a_change(spark, tmp_path):
    criteria = FileCriteria(prefix=Criterion(("A",), 2), extension=Criterion((".csv",), 2))
    start, ddl = datetime(2024, 1, 1), "s string, name string, at timestamp, change int"

    def wave(*rows):
        data = [(s, name, start + timedelta(days=day), change) for s, name, day, change in rows]
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        alerts = watch_sets(stream, criteria, "s", "name", "at", "5 days", change="change")
        sink = alerts.writeStream.option("checkpointLocation", str(tmp_path / "c")).format("parquet").option("path", str(tmp_path / "out"))
        sink.trigger(availableNow=True).start().awaitTermination()
        rows = sorted((str(r["file_set"]), r["state"], r["found_total"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
        new = list(rows)
        for row in told_list:
            new.remove(row)
        told_list.extend(new)
        return new

    told_list = []
    assert wave(("x", "A1.csv", 0, 1), ("x", "A2.csv", 0, 1), ("y", "A1.csv", 0, 1), (None, "B.csv", 1, 1), ("x", None, 1, 1)) == [("x", "COMPLETE", 2)]
    assert wave(("x", "A3.csv", 2, 1), ("x", "B.csv", 3, 1)) == []
    assert wave(("x", "A3.csv", 4, -1), ("z", "A1.csv", 9, 1)) == [("None", "OVERDUE", 0), ("x", "COMPLETE", 2), ("y", "OVERDUE", 1)]
    assert wave(("y", "A2.csv", 9, 1)) == [("y", "COMPLETE", 2)]


def test_shards_tell_what_single_sets_tell(spark, tmp_path, monkeypatch):
    criteria = FileCriteria(prefix=Criterion(("A",), 2), extension=Criterion((".csv",), 2))
    draw, ddl = Random(3), "s string, name string, at timestamp, change int"
    waves = [
        [(draw.choice([None, *"abcdefghijkl"]), draw.choice(["A1.csv", "A2.csv", "B.csv", "B", None]),
          draw.choice([None, datetime(2024, 1, 1) + timedelta(days=6 * w + draw.randint(1, 6))]), draw.choice([1, 1, -1])) for _ in range(25)]
        for w in range(4)
    ]

    def told(shards):
        monkeypatch.setattr(monitor, "SHARDS", shards)
        root, held = tmp_path / str(shards), 0
        for rows in waves:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(root / "in"))
            alerts = watch_sets(spark.readStream.schema(ddl).parquet(str(root / "in")), criteria, "s", "name", "at", "5 days", change="change")
            sink = alerts.writeStream.option("checkpointLocation", str(root / "c")).format("parquet").option("path", str(root / "out"))
            run = sink.trigger(availableNow=True).start()
            run.awaitTermination()
            held = max([held, *(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"])])
        return held, Counter(map(tuple, spark.read.parquet(str(root / "out")).collect()))

    (few, in_shards), (many, alone) = told(2), told(1 << 40)
    assert few == 2 and many == 13
    assert in_shards == alone and {r[1] for r in alone} == {"COMPLETE", "OVERDUE"}
