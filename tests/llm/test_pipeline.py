import pytest

import corpus_pipeline as p


@pytest.fixture
def folder(spark, tmp_path, prose):
    """A small corpus with a case for every stage."""
    good = {i: "\n".join(" ".join(prose((i, j), 30)) for j in range(4)) for i in range(60)}
    item, line = " ".join(prose("item", 30)), " ".join(prose("line", 60))
    rows = list(good.items())
    rows += [(100 + i, " ".join(w + "%%%" for w in prose(("bad", i), 80))) for i in range(30)]
    rows += [(200, f"{good[1]}\n{line}"), (201, f"{' '.join(prose(201, 90))}\n{line}\n{' '.join(prose(202, 30))}")]
    rows += [(210, good[5].replace("\n", " ")), (211, good[5].replace("\n", " ").replace(" ", "  ", 1))]
    rows += [(220, f"{' '.join(prose(220, 60))} {item} {' '.join(prose(221, 60))}"), (230, None), (231, ""), (None, "no id " * 30)]
    docs = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "extra") for i, t in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, row string"
    spark.createDataFrame(docs, names).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i, _ in rows if i is not None and i < 130]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_every_stage_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    seen = []
    for i, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, folder)
        if i + 1 < len(p.STAGES):
            assert out.columns == names
        out.write.parquet(f"{folder}/out{i}")
        docs = spark.read.parquet(f"{folder}/out{i}")
        seen.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    quality, lines, near, clean, mixed = seen
    assert not any(100 <= i < 130 for i in quality if i is not None)
    assert set(range(60)) <= set(quality)
    assert lines[200] and lines[200].count("\n") == 0 and lines[201].count("\n") == 1
    assert {i: lines[i] for i in range(60)} == {i: quality[i] for i in range(60)}
    assert len({5, 210, 211} & set(near)) == 1 and set(range(60)) <= set(near)
    assert 220 in near and 220 not in clean and set(near) - set(clean) == {220}
    assert set(mixed) <= set(clean) and mixed


def test_run_gives_the_last_stage(spark, folder):
    once, again = (sorted((str(r.doc_id), r.copy) for r in p.run(spark, folder).collect()) for _ in range(2))
    assert once == again and once


def test_empty_table(spark, folder, tmp_path):
    empty = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for i, (_, stage) in enumerate(p.STAGES):
        stage(spark, empty, folder).write.parquet(f"{folder}/none{i}")
        assert spark.read.parquet(f"{folder}/none{i}").count() == 0
