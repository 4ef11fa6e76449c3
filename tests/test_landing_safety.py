import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from carestrata.operators import audit
from carestrata.plans.tables import BatchTable, SchemaConflict
from carestrata.sources import files

AT = datetime(2024, 1, 1)


def test_eight_jobs_get_eight_ids(spark, tmp_path):
    log = audit.audit_row(spark, 4, "P", "S", "COMPLETED", AT)
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: audit.claim_batch_id(spark, str(tmp_path), log, "P", "S"), range(8)))
    assert sorted(ids) == list(range(5, 13))
    assert audit.claim_batch_id(spark, str(tmp_path), log, "P", "T") == 1


def test_moves_leave_no_record(spark, tmp_path):
    (tmp_path / "in").mkdir()
    moves = str(tmp_path / "moves")
    for n, text in enumerate(("one", "two", "three")):
        (tmp_path / "in/a.csv").write_text(text)
        files.put_away(spark, str(tmp_path / "in/a.csv"), str(tmp_path / "old"), moves)
    found = {p.name: p.read_text() for p in (tmp_path / "old").glob("*.csv")}
    assert found == {"a.csv": "one", "a.1.csv": "two", "a.2.csv": "three"}
    assert not list((tmp_path / "moves").glob("*.json")) and files.finish_moves(spark, moves) == []


@pytest.mark.parametrize("state", ["before", "after", "copied", "half copied"])
def test_a_rerun_finishes_what_a_crash_left(spark, tmp_path, state):
    source, target = tmp_path / "a.csv", tmp_path / "old" / "a.csv"
    (tmp_path / "old").mkdir()
    (tmp_path / "moves").mkdir()
    (tmp_path / "moves/x.json").write_text(json.dumps({"source": str(source), "target": str(target), "size": 3}))
    (tmp_path / "moves/y.json").write_text('{"source": "bro')
    if state != "after":
        source.write_text("one")
    if state != "before":
        target.write_text("on" if state == "half copied" else "one")
    assert files.finish_moves(spark, str(tmp_path / "moves")) == [str(target)]
    assert target.read_text() == "one" and not source.exists() and not list((tmp_path / "moves").glob("*.json"))


def test_a_file_that_is_nowhere_is_reported(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"source": str(tmp_path / "a"), "target": str(tmp_path / "b"), "size": 3}))
    with pytest.raises(OSError, match="neither"):
        files.finish_moves(spark, str(tmp_path))


def test_columns_that_come_later(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"))
    one = lambda n, **values: spark.createDataFrame([(*values.values(), n)], ", ".join(f"{k} string" for k in values) + ", META_BATCH_ID bigint")
    table.replace(one(1, v="a"), 1)
    table.replace(one(2, v="b", w="x"), 2)
    table.replace(one(3, V="c"), 3)
    rows = {r["META_BATCH_ID"]: (r["v"], r["w"]) for r in table.read().collect()}
    assert rows == {1: ("a", None), 2: ("b", "x"), 3: ("c", None)}
    assert table.read(1).columns == ["v", "w", "META_BATCH_ID"]
    table.replace(one(2, v="b", w="x").limit(0), 2)
    assert table.read(2).count() == 0 and table.read().count() == 2
    with pytest.raises(SchemaConflict, match="w: string, now int"):
        table.append(spark.createDataFrame([(1, 4)], "w int, META_BATCH_ID bigint"))
    assert table.read().count() == 2
