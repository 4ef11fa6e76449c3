import hashlib
import math
from collections import Counter

import pytest

from carestrata.llm import mixing as m


def poisson_at(u, rate):
    p = c = math.exp(-rate)
    k = 0
    while c <= u and k < rate + 12 * math.sqrt(rate) + 30:
        k += 1
        p *= rate / k
        c += p
    return k


def times(key, rate, seed=m.SEED):
    parts = max(1, math.ceil(rate / m.SPLIT))
    numbers = [int(hashlib.md5(f"{seed}:{key}:{j}".encode()).hexdigest()[:13], 16) / 2**52 for j in range(parts)]
    return sum(poisson_at(u, rate / parts) for u in numbers)


def test_counts_against_a_plain_loop(docs):
    rows = [(i, f"text {i}") for i in range(2000)]
    frame = docs(rows, lambda i: "big" if i % 10 < 7 else None if i % 10 == 7 else "rare" if i == 8 else "small")
    weights = {"big": 1.0, "rare": 2.0, "small": 3.0, "absent": 5.0}
    found = m.mixed(frame, weights, default=0.5).collect()
    n = Counter(r.source for r in frame.collect())
    total = sum(weights.get(s, 0.5) for s in n)
    rate = {s: 2000 * weights.get(s, 0.5) / (total * n[s]) for s in n}
    assert rate["rare"] > 600
    got = Counter(r.doc_id for r in found)
    for r in frame.collect():
        assert got[r.doc_id] == times(r.doc_id, rate[r.source])
    share = Counter(r.source for r in found)
    for s in n:
        assert share[s] / 2000 == pytest.approx(weights.get(s, 0.5) / total, rel=0.2)
    assert {r.copy for r in found if r.doc_id == 8} == set(range(1, got[8] + 1))


def test_odd_rows(docs):
    rows = [(None, "a"), (None, "a"), (None, None), (1, ""), (1, ""), (2, "x" * 100_000)]
    found = Counter((r.doc_id, r.text) for r in m.mixed(docs(rows), {}, default=1.0).collect())
    null = hashlib.md5(b"a").hexdigest(), hashlib.md5(b"").hexdigest()
    assert found[None, "a"] == 2 * times(f"null:{null[0]}", 1.0) and found[None, None] == times(f"null:{null[1]}", 1.0)
    assert found[1, ""] == 2 * times(1, 1.0)
    assert m.mixed(docs([])).count() == 0
    assert m.mixed(docs(rows), {"a": 0.0}).count() == 0
    with pytest.raises(ValueError):
        m.mixed(docs(rows), {"a": -1.0})


def test_order_and_columns(docs):
    frame = docs([(i, "t") for i in range(300)])
    a, b = m.mixed(frame, {}), m.mixed(frame.repartition(7), {})
    assert a.columns == [c for c in frame.columns if c != "copy"] + ["rate", "copy", "shuffle_key"]
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    for part in a.select("shuffle_key").rdd.glom().collect():
        assert part == sorted(part)


def test_rate_is_a_poisson_mean(docs):
    frame = docs([(i, "t") for i in range(4000)])
    got = Counter(r.doc_id for r in m.mixed(frame, {}).collect())
    counts = Counter(got[i] for i in range(4000))
    for k in range(4):
        assert counts[k] / 4000 == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.03)
