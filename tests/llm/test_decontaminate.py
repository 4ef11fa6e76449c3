import math
import random
import re

from carestrata.llm import decontaminate as m


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if not words:
        return set()
    if len(words) < m.SHINGLE:
        return {("whole", *words)}
    return {tuple(words[i : i + m.SHINGLE]) for i in range(len(words) - m.SHINGLE + 1)}


def test_against_all_pairs(spark, docs, prose):
    r = random.Random(1)
    items = [(i, " ".join(prose(("i", i), r.randint(5, 60)))) for i in range(25)]
    items += [(100, "Two words"), (101, None), (102, ""), (103, "?!"), (3, items[3][1]), (None, items[4][1])]
    rows = []
    for i in range(80):
        words = prose(i, r.randint(3, 300))
        if i % 2:
            own = items[r.randrange(25)][1].split()
            for _ in range(i % 5):
                own[r.randrange(len(own))] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in own]
        rows.append((i, " ".join(words)))
    rows += [(200, "two, WORDS"), (201, "other two words"), (202, None), (203, ""), (1, rows[1][1]), (None, rows[3][1])]
    want = set()
    for d, text in rows:
        have = shingles(text)
        for i, item in items:
            asked = shingles(item)
            if asked and len(asked & have) >= math.ceil(m.THRESHOLD * len(asked) - 1e-9):
                want.add((d, i, len(asked & have), len(asked)))
    frame, bench = docs(rows), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, copy int")
    found = [(x.doc_id, x.item_id, x.n_shared, x.n_item) for x in m.contained(frame, bench).collect()]
    assert set(found) == want and len(found) == len(want) and len(want) > 10
    clean = m.decontaminated(frame, bench)
    assert clean.columns == frame.columns
    bad = {(d, dict(rows).get(d) if d is not None else rows[3][1]) for d, *_ in want}
    assert sorted(map(str, [(x.doc_id, x.text) for x in clean.collect()])) == sorted(str(x) for x in rows if x not in bad)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert m.contained(docs([]), some).count() == 0
    assert m.decontaminated(docs([(1, "a b c d e f")]), none).count() == 1
    assert m.decontaminated(docs([(1, "a b c d e f")]), some).count() == 0
