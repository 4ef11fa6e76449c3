import random
import re

import numpy as np
import pytest
import xxhash

from carestrata.llm import simhash as m
from carestrata.llm.components import components


def fingerprint(text, k=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def least_reachable(ids, prints, radius=4):
    """Smallest id of each one's component, by comparing everything."""
    label = {f: f for f in prints.values()}

    def top(f):
        while label[f] != f:
            f = label[f]
        return f

    known = sorted(label)
    for a in known:
        for b in known:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = top(a), top(b)
                label[max(x, y)] = min(x, y)
    least = {}
    for i in ids:
        least[top(prints[i])] = min(i, least.get(top(prints[i]), i))
    return {i: least[top(prints[i])] for i in ids}


@pytest.mark.parametrize("shard_size", [2048, 3])
def test_against_all_pairs(docs, prose, shard_size):
    r = random.Random(1)
    rows = []
    for i in range(60):
        words = prose(i // 4, 120)
        for _ in range(i % 4):
            words[r.randrange(120)] = f"new{r.random()}"
        rows.append((i, " ".join(words)))
    rows += [(70, None), (71, ""), (72, " \t\n"), (73, "one two"), (74, "ONE  two"), (75, "é\x85x y"), (76, rows[0][1])]
    found = m.near_duplicates(docs(rows), shard_size=shard_size).collect()
    prints = {i: fingerprint(t) for i, t in rows}
    assert {f.doc_id: f.fp & (2**64 - 1) for f in found} == prints
    assert {f.doc_id: f.component_id for f in found} == least_reachable([i for i, _ in rows], prints)


def test_chains_of_links_are_one_group(spark):
    r = random.Random(2)
    value, chain = r.getrandbits(64), []
    for _ in range(20):
        chain.append(value)
        for b in r.sample(range(64), 4):
            value ^= 1 << b
    others = [r.getrandbits(64) for _ in range(200)]
    signed = np.array(sorted({*chain, *others}), np.uint64).view(np.int64).tolist()
    for shard_size in (2, 2048):
        roots = m.near_groups(spark.createDataFrame([(x,) for x in signed], "fp long"), shard_size=shard_size).collect()
        assert {x.fp & (2**64 - 1) for x in roots} == set(chain) and len({x.root for x in roots}) == 1


def test_tree_finds_all_within_the_radius():
    r = random.Random(3)
    center = r.getrandbits(64)
    values = list({center ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 8))) for _ in range(300)})
    tree = m.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        for radius in (0, 4):
            assert sorted(tree.within(v, radius)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= radius]


def test_one_of_each_group_stays(docs, prose):
    text, other = " ".join(prose(1, 90)), " ".join(prose(2, 90))
    rows = [(3, text), (1, text), (1, text), (9, text), (1, other), (None, "x y"), (None, "x y"), (4, None), (5, "")]
    kept = m.without_near_duplicates(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        [("1", text), ("1", other), ("None", "x y"), ("4", "")]
    )
    assert m.without_near_duplicates(docs([])).count() == 0


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 5001 + i) for i in range(60)] + [(7, 7)]
    found = {x.node: x.label for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for link in links for x in link}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert set(found) == linked
    for x in linked:
        for y in linked:
            assert (found[x] == found[y]) == (label[x] == label[y])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_of_a_rising_chain(spark, monkeypatch):
    from carestrata.llm import components as c

    labels = []
    monkeypatch.setattr(c, "kept", lambda df, label: labels.append(label) or m.kept(df, label))
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    found = c.components(chain).collect()
    assert len(found) == 201 and len({r.label for r in found}) == 1
    assert labels.count("cc-links") - 1 <= 12


@pytest.mark.parametrize("size", [2, 5, 64])
def test_hot_shards_lose_no_link(spark, size):
    r = random.Random(size)
    high = r.getrandbits(40) << 24  # two blocks and more are the same in all
    values = sorted({high | r.getrandbits(24) for _ in range(60)} | {high | 1 << i for i in range(24)} | {r.getrandbits(64) for _ in range(40)})
    signed = [v - (v >> 63 << 64) for v in values]
    found = {x.fp & (1 << 64) - 1: x.root for x in m.near_groups(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, size).collect()}
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    linked = set()
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                root[top(a)] = top(b)
                linked |= {a, b}
    assert set(found) == linked
    assert all((found[a] == found[b]) == (top(a) == top(b)) for a in linked for b in linked)
