import random

import pytest

from carestrata.llm import line_dedup as m


def deduped(rows, least):
    """Plain form: each line is compared along every diagonal of two places; runs of `least` words go at the later one."""
    keys = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    lines = {k: [x.strip(" ") for x in (k[1] or "").split("\n")] for k in keys}
    gone = {k: set() for k in keys}
    for n, key in enumerate(keys):
        for other in keys[: n + 1]:
            ours, theirs = lines[key], lines[other]
            for shift in range(1 if other is key else 1 - len(theirs), len(ours)):
                run = []
                for p in range(max(0, shift), min(len(ours), len(theirs) + shift) + 1):
                    if p < min(len(ours), len(theirs) + shift) and ours[p] == theirs[p - shift]:
                        run.append(p)
                        continue
                    if sum(ours[i].count(" ") + 1 for i in run) >= least and run:
                        gone[key] |= set(run)
                    run = []
    return {k: None if k[1] is None else "\n".join(x for i, x in enumerate(k[1].split("\n")) if i not in g) for k, g in gone.items()}


@pytest.mark.parametrize("least", [1, 4, 8])
def test_against_a_plain_loop(docs, least):
    r = random.Random(least)
    pool = ["a b c", "d", "", "e f g h i j k l m", " d ", "n o", "p q r s t u v w x y z"]
    rows = [(i, "\n".join(r.choice(pool) + (str(r.randint(0, 9)) if r.random() < 0.3 else "") for _ in range(r.randint(1, 12)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "\n\n\n"), (93, "long " * 3000), (94, "long " * 3000), (95, "\n".join(["same line of a few words here ok"] * 60))]
    found = {r.doc_id: r.text for r in m.dedup_lines(docs(rows), least).collect()}
    want = deduped(rows, least)
    assert found == {i: want[i, t] for i, t in rows}


def test_odd_rows(docs):
    line = "one two three four five six seven eight nine"
    frame = docs([(2, line), (2, line), (None, line), (1, f"{line}\nmy own")])
    found = m.dedup_lines(frame)
    assert found.columns == [c for c in frame.columns if c != "text"] + ["text", "n_lines", "n_deleted"]
    got = sorted((str(r.doc_id), r.text, r.n_deleted) for r in found.collect())
    assert got == [("1", "my own", 1), ("2", "", 1), ("2", "", 1), ("None", line, 0)]
    assert m.dedup_lines(docs([])).count() == 0


def test_repeats_within_a_document(docs):
    long = "one two three four five six seven eight nine"
    (row,) = m.dedup_lines(docs([(1, f"{long}\nx\n{long}\ny\n{long}")])).collect()
    assert row.text == f"{long}\nx\ny" and (row.n_lines, row.n_deleted) == (5, 2)


def test_short_lines_at_the_ends_of_a_run(docs):
    long = "one two three four five six seven eight nine"
    text = f"Oh.\n{long}\nLes.\n\nFin."
    found = m.dedup_lines(docs([(1, text), (2, text), (3, f"other\n{text}\nmore"), (4, f"Les.\n{long}\nOh.\nFin.")])).collect()
    assert {r.doc_id: r.text for r in found} == {1: text, 2: "", 3: "other\nmore", 4: "Les.\nOh.\nFin."}


def test_sql_has_the_same_rule(spark, tmp_path, prose):
    import duckdb

    r = random.Random(3)
    pool = [" ".join(prose(i, r.choice([1, 2, 5, 9, 12]))) for i in range(25)]
    rows = [(i, "\n".join(r.choices(pool, k=r.randint(1, 9)))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    theirs = sorted(con.sql(m.OP10_SQL).fetchall())
    assert theirs == sorted(tuple(r) for r in m.op10_line_dedup(spark, str(tmp_path)).collect())
    want = deduped(rows, m.MIN_WORDS)
    assert {r[0]: r[1] for r in theirs} == {i: want[i, t] for i, t in rows}
