import zlib

import numpy as np
import pyarrow as pa

from carestrata.llm import quality as m


def corpus(prose, n=240):
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60)
        if i % 4 == 0:
            words = [w + "%%%" for w in words] if i % 8 else [w for w in words[:8] for _ in range(8)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 != 0), 0))
    return rows, labels


def test_held_out_accuracy(spark, docs, prose):
    rows, labels = corpus(prose)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    extra = [(None, "some words"), (1000, None), (1001, ""), (1, rows[1][1]), (1002, "w " * 5000)]
    found = m.judge(docs(rows + extra), labels).collect()
    assert len(found) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in found)
    truth = {i: int(i % 4 != 0) for i, _ in rows}
    out = [r for r in found if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    empty = {r.score for r in found if not r.text}
    assert len(empty) == 1
    assert len({r.score for r in found if r.doc_id == 1}) == 1


def test_held_out_rows_do_not_matter(spark, docs, prose):
    rows, labels = corpus(prose, 80)
    frame = docs(rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    a, b = (m.fit(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert (a == b).all() and a.any()


def test_nothing_to_learn_from(spark, docs):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    (row,) = m.judge(docs([(1, "a b")]), labels).collect()
    assert row.score == 0.5 and row.predicted == 0
    assert m.judge(docs([]), labels).count() == 0


def test_score_is_the_sparse_dot_product(spark, docs, prose):
    p = m.Ftrl(bits=10)
    w = np.random.default_rng(1).normal(size=(1 << 10) + 1).astype(np.float32)
    texts = [" ".join(prose(i, i * 3)) for i in range(20)] + ["x" * (1 << 20)]
    got = [r.score for r in m.score(docs(list(enumerate(texts))), w, p).orderBy("doc_id").collect()]
    for text, score in zip(texts, got):
        ((_, slot, _, counts),) = m.features(pa.array([text]), p)
        margin = p.scale * sum(float(w[s]) for s in slot) / max(1, counts[0]) + float(w[-1])
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-4


def test_ftrl_step_against_a_plain_loop():
    p = m.Ftrl(bits=6, epochs=1)
    texts, labels = ["a b c a", "d e f", "a b", "e e e e"] * 5, [1.0, 0.0, 1.0, 0.0] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(labels), pa.array(texts)], ["label", "text"])
    (out,) = m.trainer(p)(iter([batch]))
    got = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    size = (1 << 6) + 1
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        step = (p.beta + n[i] ** 0.5) / p.alpha
        if i == size - 1:
            return -z[i] / step
        return 0.0 if abs(z[i]) <= p.l1 else -(z[i] - np.sign(z[i]) * p.l1) / (step + p.l2)

    for text, label in zip(texts, labels):
        ((_, slot, _, counts),) = m.features(pa.array([text]), p)
        x = {size - 1: 1.0}
        for s in slot.tolist():
            x[s] = x.get(s, 0) + p.scale / counts[0]
        g0 = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in x.items()))) - label
        ws = {i: weight(i) for i in x}
        for i, v in x.items():
            g = g0 * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / p.alpha * ws[i]
            n[i] += g * g
    for i in range(size):
        assert abs(got.get(i, 0.0) - weight(i)) < 1e-9


def test_clashing_labels_are_not_learnt(spark, docs, prose):
    rows, labels = corpus(prose, 80)
    clash = [(i, 1 - q, t) for i, q, t in labels[::3]]
    ids = {i for i, _, _ in clash}
    form = "doc_id long, quality int, toxic int"
    a = m.fit(docs(rows), spark.createDataFrame(labels + clash + labels, form))
    b = m.fit(docs(rows), spark.createDataFrame([x for x in labels if x[0] not in ids], form))
    assert (a == b).all() and a.any()


def test_sharded_fit_is_the_average_of_plain_fits(spark, docs, prose):
    p = m.Ftrl(bits=8, epochs=1, shards=3)
    rows, labels = corpus(prose, 40)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    keys = docs(rows).selectExpr("doc_id", "pmod(hash(pmod(xxhash64('shard', doc_id), 3)), 3) AS shard", "xxhash64(0, doc_id) AS at", "text").collect()
    label = {i: float(q) for i, q, _ in labels}
    dealt = {}
    for r in keys:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            dealt.setdefault(r.shard, []).append((r.at, label[r.doc_id], r.text))
    sums = np.zeros((1 << 8) + 1)
    for part in dealt.values():
        _, ys, texts = zip(*sorted(part))
        (out,) = m.trainer(p)(iter([pa.RecordBatch.from_arrays([pa.array(ys), pa.array(texts)], ["label", "text"])]))
        sums[out.column(0).to_numpy()] += out.column(1).to_numpy()
    assert np.allclose(m.fit(docs(rows), frame, p), sums / len(dealt), atol=1e-9)
