from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from carestrata.operators.history import track_history
from carestrata.operators.merge import BatchStamp, fits_broadcast, merge_changed, merge_counts, reject_repeats
from carestrata.plans.gold import staged_upsert, upsert
from carestrata.plans.tables import GoldTable, Head, commit
from carestrata.settings import TargetTable

FIRST = BatchStamp("P", "S", 1, datetime(2024, 1, 1))
SECOND = BatchStamp("P", "S", 2, datetime(2024, 2, 1))
DDL = "k string, a string, b string"


def model(gold: dict, batch: dict, sep: str) -> dict:
    """Plain statement of the merge: key -> (a, b, batch, updating batch)."""
    out = dict(gold)
    for key, (a, b) in batch.items():
        if key not in out:
            out[key] = (a, b, 2, None)
        elif sep.join((out[key][0] or "", out[key][1] or "")) != sep.join((a or "", b or "")):
            out[key] = (a, b, out[key][2], 2)
    return out


def as_dict(df) -> dict:
    return {r["k"]: (r["a"], r["b"], r["META_BATCH_ID"], r["META_UPD_BATCH_ID"]) for r in df.collect()}


text = st.sampled_from([None, "", "A", "B", "AB"])
rows = st.dictionaries(st.sampled_from("pqrstuvw"), st.tuples(text, text), max_size=8)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
@pytest.mark.parametrize("sep", ["", "|"])
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(gold=rows, batch=rows)
def test_merge_equals_model(spark, strategy, sep, gold, batch):
    old = FIRST.put_on(spark.createDataFrame([(k, *v) for k, v in gold.items()], DDL))
    new = spark.createDataFrame([(k, *v) for k, v in batch.items()], DDL)
    merged = merge_changed(old, new, ["k"], ["a", "b"], SECOND, sep=sep, strategy=strategy)
    expected = model({k: (*v, 1, None) for k, v in gold.items()}, batch, sep)
    assert as_dict(merged) == expected
    assert merged.count() == len(gold.keys() | batch.keys())


def test_merge_again_changes_nothing(spark):
    old = FIRST.put_on(spark.createDataFrame([("x", "1", "2"), ("y", "1", None)], DDL))
    batch = spark.createDataFrame([("x", "9", "2"), ("z", None, None)], DDL)
    once = merge_changed(old, batch, ["k"], ["a", "b"], SECOND)
    again = merge_changed(once, batch, ["k"], ["a", "b"], BatchStamp("P", "S", 3, datetime(2024, 3, 1)))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_null_keys(spark, strategy):
    old = FIRST.put_on(spark.createDataFrame([(None, "g", None), ("x", "g", None)], DDL))
    batch = spark.createDataFrame([(None, "s", None), (None, "s", None), ("x", "g", "")], DDL)
    args = (old, batch, ["k"], ["a", "b"], SECOND)
    inserted = merge_changed(*args, strategy=strategy)
    assert sorted((r["k"] or "-", r["a"]) for r in inserted.collect()) == [("-", "g"), ("-", "s"), ("-", "s"), ("x", "g")]
    dropped = merge_changed(*args, null_keys="drop", strategy=strategy)
    assert sorted((r["k"] or "-", r["a"]) for r in dropped.collect()) == [("-", "g"), ("x", "g")]


def test_repeated_source_key_is_refused(spark):
    twice = spark.createDataFrame([("x", "1", "2"), ("x", "1", "3")], DDL)
    with pytest.raises(PySparkException, match="holds a key twice"):
        reject_repeats(twice, ["k"]).collect()


def test_composite_key_and_counts(spark):
    ddl = "k string, n string, v string"
    old = FIRST.put_on(spark.createDataFrame([("x", "1", "a"), ("x", "2", "b"), ("y", "1", "c")], ddl))
    batch = spark.createDataFrame([("x", "1", "a"), ("x", "2", "B"), ("z", "1", "d")], ddl)
    merged = merge_changed(old, batch, ["k", "n"], ["v"], SECOND)
    assert merge_counts(merged, 2).first().asDict() == {"inserted": 1, "updated": 1, "gold_total": 4}
    changed = merged.where("META_UPD_BATCH_ID = 2").first()
    assert (changed["v"], changed["META_DATE_UPDATE"], changed["META_DATE_INSERT"]) == ("B", SECOND.as_of, FIRST.as_of)


def test_size_check(spark):
    df = spark.createDataFrame([("x", "a" * 100, None)] * 10, DDL)
    assert fits_broadcast(df, ["k", "a", "b"], limit=2000)
    assert not fits_broadcast(df, ["k", "a", "b"], limit=1000)
    assert fits_broadcast(df.limit(0), ["k"], limit=0)


TARGET = TargetTable("ITEMS", ("k",), ("a", "b"))


def test_gold_versions(spark, tmp_path):
    gold = GoldTable(spark, str(tmp_path), TARGET, buckets=3)
    assert gold.current().count() == 0
    first = spark.createDataFrame([(str(i), "a", None) for i in range(50)], DDL)
    assert upsert(gold, first, FIRST) == {"inserted": 50, "updated": 0, "gold_total": 50}
    second = spark.createDataFrame([(str(i), "b", None) for i in range(40, 60)], DDL)
    assert upsert(gold, second, SECOND) == {"inserted": 10, "updated": 10, "gold_total": 60}
    assert upsert(gold, second, BatchStamp("P", "S", 3, SECOND.as_of)) == {"inserted": 0, "updated": 0, "gold_total": 60}
    # one file per bucket, and earlier versions still readable
    assert gold.head().version == 3 and len(list((tmp_path / "ITEMS" / "v=2").rglob("*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "ITEMS" / "v=1")).count() == 50


def test_small_batches_write_only_their_buckets(spark, tmp_path):
    gold = GoldTable(spark, str(tmp_path), TARGET, buckets=40)
    upsert(gold, spark.createDataFrame([(str(i), "a", None) for i in range(2000)], DDL), FIRST)
    files = lambda v: {p.parent.name for p in (tmp_path / "ITEMS" / f"v={v}").rglob("*.parquet")}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "ITEMS" / "v=1").rglob("*.parquet")}
    batch = spark.createDataFrame([("7", "b", None), ("1999", "a", None), ("new", "c", None)], DDL)
    assert upsert(gold, batch, SECOND) == {"inserted": 1, "updated": 1, "gold_total": 2001}
    hit = gold.touched(batch, gold.head())
    assert 1 <= len(hit) <= 3 and files(2) == {f"_bucket={b}" for b in hit}
    assert before == {p: p.stat().st_mtime_ns for p in before}
    rows = gold.current()
    assert rows.count() == 2001 and {r["k"]: r["a"] for r in rows.where("k in ('7', 'new', '8')").collect()} == {"7": "b", "8": "a", "new": "c"}
    # the old version stays as it was; what the current one refers to is not expired
    assert gold.at(Head(1, str(tmp_path / "ITEMS/_manifest/v=1"), 40)).where("k = '7'").first()["a"] == "a"
    assert gold.expire(keep=1) == [1] and gold.current().count() == 2001
    assert len(files(1)) == 40 - len(hit) and sum(r["rows"] for r in gold.manifest(gold.head())) == 2001
    upsert(gold, batch.limit(0), BatchStamp("P", "S", 3, SECOND.as_of))
    assert gold.current().count() == 2001 and files(3) == set()


def test_commits_of_several_tables(spark, tmp_path):
    one, two = (GoldTable(spark, str(tmp_path), TargetTable(n, ("k",), ("a", "b")), 2) for n in ("ONE", "TWO"))
    rows = spark.createDataFrame([("x", "a", None)], DDL)
    staged = {g.target.name: staged_upsert(g, rows, FIRST)[0] for g in (one, two)}
    assert one.current().count() == 0 == two.head().version
    commit(spark, str(tmp_path), staged, 1, FIRST.as_of)
    assert one.current().count() == 1 == two.current().count() and two.head().version == 1
    assert len(list((tmp_path / "_commits").glob("*.json"))) == 1


def test_unpublished_version_is_ignored_and_replaced(spark, tmp_path):
    gold = GoldTable(spark, str(tmp_path), TARGET, buckets=2)
    upsert(gold, spark.createDataFrame([("x", "a", None)], DDL), FIRST)
    # a run that died after writing some of version 2
    spark.createDataFrame([("junk", "j", None)], DDL).write.parquet(str(tmp_path / "ITEMS" / "v=2"))
    assert [r["k"] for r in gold.current().collect()] == ["x"]
    upsert(gold, spark.createDataFrame([("y", "a", None)], DDL), SECOND)
    assert sorted(r["k"] for r in gold.current().collect()) == ["x", "y"]


def test_gold_is_not_exchanged(spark, tmp_path):
    gold = GoldTable(spark, str(tmp_path), TARGET, buckets=6)
    batch = spark.createDataFrame([(str(i), "a", None) for i in range(200)], DDL)
    upsert(gold, batch, FIRST)
    head = gold.head()
    merged = merge_changed(gold.at(head), batch.repartition(6, "k"), ["k"], ["a", "b"], SECOND, null_keys="absent")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_history(spark):
    history = spark.createDataFrame(
        [("x", "1", "", "2024-01-01", "2299-12-31", "Y"), ("x", "0", "", "2023-01-01", "2024-01-01", "N"),
         ("y", "1", "", "2024-01-01", "2299-12-31", "Y")],
        "k string, a string, b string, VALID_FROM string, VALID_TO string, IS_CURRENT string",
    )
    batch = spark.createDataFrame([("x", "2", None), ("y", "1", None), ("z", "1", None)], DDL)
    out = track_history(history, batch, ["k"], ["a", "b"], "2024-05-01")
    assert sorted((r["k"], r["a"], r["VALID_FROM"], r["VALID_TO"], r["IS_CURRENT"]) for r in out.collect()) == [
        ("x", "0", "2023-01-01", "2024-01-01", "N"),
        ("x", "1", "2024-01-01", "2024-05-01", "N"),
        ("x", "2", "2024-05-01", "2299-12-31", "Y"),
        ("y", "1", "2024-01-01", "2299-12-31", "Y"),
        ("z", "1", "2024-05-01", "2299-12-31", "Y"),
    ]
    again = track_history(out, batch, ["k"], ["a", "b"], "2024-06-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_stamp(spark):
    rows = FIRST.put_on(spark.createDataFrame([("x", "a", "b")], DDL))
    assert rows.columns == ["META_PROGRAM_NAME", "META_SUBJECT_AREA", "META_BATCH_ID", "META_DATE_INSERT",
                            "META_DATE_UPDATE", "META_UPD_BATCH_ID", "k", "a", "b"]
    mixed = rows.unionByName(rows.withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in rows.columns[:6]}))
    assert sorted(r["META_BATCH_ID"] for r in SECOND.fill_in(mixed).collect()) == [1, 2]
