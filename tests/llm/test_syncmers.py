import hashlib
import random

import numpy as np
import pytest

from carestrata.llm import syncmers as m


def as_rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_neighbours_against_a_plain_loop(docs, prose):
    rows = [(i * 3 - 50, " ".join(prose(i, i % 40))) for i in range(90)] + [(900, "a" * 500), (901, "\U0001f600é" * 30)]
    random.Random(1).shuffle(rows)
    found = {r[0]: r for r in as_rows(m.neighbour_prints(docs(rows), blocks=7))}
    order = sorted(rows, reverse=True)
    assert len(found) == len(rows)
    for n, (i, text) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, other, following = m.prints([text, edited, after])
        assert found[i][1:3] == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert found[i][3:] == (m.written(own), m.written(other), m.likeness(own, other), m.likeness(own, following))


def test_odd_rows(docs):
    rows = [(5, None), (None, "abc" * 20), (None, "xyz"), (5, None), (4, "")]
    found = as_rows(m.neighbour_prints(docs(rows)))
    assert sorted((r[0] is None, r[0], r[1]) for r in found if r[0] is not None) == [(False, 4, 0), (False, 5, 0), (False, 5, 0)]
    assert sorted(r[1] for r in found if r[0] is None) == [3, 60]
    assert m.neighbour_prints(docs([])).count() == 0
    (alone,) = as_rows(m.neighbour_prints(docs([(1, "abcdef" * 9)])))
    assert alone[5:] == (1.0, 1.0) or alone[6] == 1.0


def test_anchors_depend_on_the_kmer_alone(prose):
    text = " ".join(prose(3, 300))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    place, value = m.anchors(points)
    chosen = dict(zip(place.tolist(), value.tolist()))
    for p in range(len(text) - m.K + 1):
        alone, hashed = m.anchors(points[p : p + m.K])
        assert (list(alone) == [0]) == (p in chosen)
        if p in chosen:
            assert hashed[0] == chosen[p]
    assert 0.1 < len(place) / len(text) < 0.25


def test_likeness(prose):
    a, b = " ".join(prose(1, 400)), " ".join(prose(2, 400))
    pa, pb, half = m.prints([a, b, a[: len(a) // 2] + b[len(b) // 2 :]])
    assert m.likeness(pa, pa) == 1 and m.likeness(pa, pb) < 0.05
    assert 0.15 < m.likeness(pa, half) < 0.55
    assert m.likeness(m.EMPTY, m.EMPTY) == 1 and m.likeness(m.EMPTY, pa) == 0
    assert m.prints(["x" * 10**6])[0][0].size == 1


def test_column_form(docs):
    frame = docs([(1, "abc"), (2, None), (3, "abc")])
    found = {r.doc_id: r.f for r in frame.select("doc_id", m.fingerprint(frame.text).alias("f")).collect()}
    assert found[1] == found[3] != "" and found[2] == ""


@pytest.mark.parametrize("seed", range(6))
def test_anchors_are_closed_syncmers(seed):
    """The definition itself: a k-mer whose least inner s-mer lies at either edge, whatever stands around it."""
    r = np.random.default_rng(seed)
    points = r.integers(97, 97 + int(r.integers(1, 6)), int(r.integers(m.K, 200))).astype(np.uint32)

    def inner(i):
        value = int(points[i])
        for j in range(1, m.S):
            value = (value * 0x100000001B3 + int(points[i + j])) % (1 << 64)
        return int(m.mixed(np.array([value], np.uint64))[0])

    want = []
    for i in range(len(points) - m.K + 1):
        hashes = [inner(i + j) for j in range(m.K - m.S + 1)]
        if min(hashes) in (hashes[0], hashes[-1]):
            want.append(i)
    place, value = m.anchors(points)
    assert place.tolist() == want
    alone = {bytes(points[p : p + m.K]): set(m.anchors(points[p : p + m.K])[1].tolist()) for p in want}
    assert all({v} == alone[bytes(points[p : p + m.K])] for p, v in zip(place.tolist(), value.tolist()))


def test_fingerprints_hold_all_anchors(docs, prose):
    """A change anywhere in a long text shows, and the likeness is that of all anchors."""
    words = prose(7, 3000)
    text, changed = " ".join(words), " ".join(words[:1500] + ["changed"] + words[1501:])
    for t, p in zip((text, changed), m.prints([text, changed])):
        places, values = m.anchors(np.frombuffer(t.encode("utf-32-le"), np.uint32))
        first = {}
        for at, value in zip(places.tolist(), values.tolist()):
            first.setdefault(value, at)
        assert list(zip(*(c.tolist() for c in p))) == list(first.items()) and len(first) > 1000
    a, b = m.prints([text, changed])
    both = set(a[0].tolist()) | set(b[0].tolist())
    assert m.likeness(a, b) == len(set(a[0].tolist()) & set(b[0].tolist())) / len(both) and 0.99 < m.likeness(a, b) < 1
    moved = m.prints([" ".join(words[1500:] + words[:1500])])[0]
    assert 0.45 < m.likeness(a, moved) < 0.55
    found = {r.doc_id: r for r in m.neighbour_prints(docs([(2, text), (1, changed)])).collect()}
    assert found[2].fingerprint == m.written(a) != found[1].fingerprint and found[2].near_next == m.likeness(a, b)


def test_rows_are_returned_in_runs(monkeypatch, prose):
    import pyarrow as pa

    texts = [" ".join(prose(i, 20)) for i in range(9)]
    rows = [[0] * 9, [i == 8 for i in range(9)], list(range(9)), texts]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in rows], ["block", "edge", "doc_id", "text"])
    whole = pa.Table.from_batches(m.compare_neighbours(iter([batch])))
    monkeypatch.setattr(m, "OUT_CHARS", 500)
    cut = list(m.compare_neighbours(iter([batch])))
    assert len(cut) > 2 and pa.Table.from_batches(cut) == whole and whole.num_rows == 8


def test_texts_without_anchors_are_no_empty_ones(prose):
    texts = [t for i in range(300) if len(t := " ".join(prose(i, 6))[: m.K + 2]) > m.K and not len(m.anchors(np.frombuffer(t.encode("utf-32-le"), np.uint32))[0])]
    found = m.prints([*texts, ""])
    assert len(texts) > 10 and all(p[0].size == 1 for p in found[:-1]) and not found[-1][0].size
    assert m.likeness(found[0], found[1]) == m.likeness(found[0], found[-1]) == 0 and m.likeness(found[0], found[0]) == 1
