import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from carestrata.llm import prefixes as m

COLUMNS = "conv_id long, turn long, role string, text string, k1 long, block string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain(rows, rebuild):
    """The trie by dictionaries of whole prefixes."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    seqs = own
    if rebuild:
        seqs = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            seqs[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    leaves = [n for n in members if not any(len(k) == len(n) + 1 and k[: len(n)] == n for k in members)]
    out = []
    for n, cs in members.items():
        inside = [k for k in members if k[: len(n)] == n]
        ends = sorted(c for c in cs if len(seqs[c]) == len(n))
        out.append(
            {
                "conv_id": min(cs),
                "depth": len(n),
                "parent_conv_id": min(members[n[:-1]]) if n else None,
                "n_convs": len(cs),
                "n_children": sum(len(k) == len(n) + 1 for k in inside),
                "n_leaves": sum(k in leaves for k in inside),
                "saved_tokens": sum((len(members[k]) - 1) * len(k[-1][1]) for k in inside if k),
                "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else EMPTY,
            }
        )
    return sorted(out, key=lambda r: (r["depth"], r["conv_id"]))


def sample(seed):
    r = random.Random(seed)
    rows = []
    for c in [*r.sample(range(0, 420), 70), 0, 100, 200]:
        for t in range(r.randint(1, 7)):
            rows.append((c, r.choice([t, t, None]), r.choice(["user", None]), r.choice(["a", "bé", "", None]), 1, "x"))
    rows += [(7, t, "user", "long " * (t % 3), 1, "x") for t in range(40)] + [(8, t, "user", "long " * (t % 3), 1, "x") for t in range(39)]
    rows += [(c, 0, "user", "same", 1, "x") for c in range(300, 340)] * 2
    return rows + [(None, 1, "user", "nobody's", 1, "x"), (9, 0, "user", "z" * 100_000, 1, "x")]


def found(frame):
    rows = [r.asDict() for r in frame.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    return sorted(rows, key=lambda r: (r["depth"], r["conv_id"]))


@pytest.mark.parametrize("width", [1, 3, 8])
def test_against_dictionaries(spark, width):
    rows = sample(width)
    frame = spark.createDataFrame(rows, COLUMNS)
    assert found(m.prefix_trie(frame, width)) == plain(rows, False)
    assert found(m.trie_of(m.rebuilt(m.turns_of(frame)), width)) == plain(rows, True)


def test_no_conversation(spark):
    assert m.prefix_trie(spark.createDataFrame([], COLUMNS)).count() == 0
    assert m.trie_of(m.rebuilt(m.turns_of(spark.createDataFrame([], COLUMNS)))).count() == 0


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    import duckdb

    rows = [r for r in sample(9) if r[0] is not None]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    theirs = con.sql(m.OP12_SQL)
    theirs = [dict(zip(theirs.columns, r)) for r in theirs.fetchall()]
    assert sorted(theirs, key=lambda r: (r["depth"], r["conv_id"])) == found(m.op12_conversation_prefix_trie(spark, str(tmp_path)))
