import hashlib
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from carestrata.llm import alignment as m

pytestmark = pytest.mark.skipif(not Path(m.FIRST).exists(), reason="needs the vocabulary files")


def plain(rows):
    """The contract over whole texts, by bytes alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(m.FIRST)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=m.SECOND)
    from tokenizers.decoders import ByteLevel  # noqa: F401

    hidden = [x for x in range(256) if x not in set(m.SHOWN)]
    byte_of = {chr(x): x for x in m.SHOWN} | {chr(256 + i): x for i, x in enumerate(hidden)}
    cut, docs = [], defaultdict(set)
    for n, (i, text) in enumerate(rows):
        found = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spelt = [
                [bytes(byte_of[c] for c in a.id_to_token(x)) for x in ids[0]],
                [bytes([int(b.id_to_piece(x)[3:-1], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids[1]],
            ]
            if all(b"".join(s) == (" " + text).encode() for s in spelt):
                ends = [[sum(map(len, s[: k + 1])) for k in range(len(s))] for s in spelt]
                at = [0, 0]
                for e in sorted(set(ends[0]) & set(ends[1])):
                    to = [ends[k].index(e) + 1 for k in (0, 1)]
                    found.append((ids[0][at[0] : to[0]], ids[1][at[1] : to[1]]))
                    at = to
        cut.append((i, found))
        for x, y in found:
            for p in x:
                for q in y:
                    docs[p, q].add(n)
    count = {k: len(v) for k, v in docs.items()}
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for i, found in cut:
        pairs = [(p, q) for x, y in found for p in x for q in y]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in found)
        out.append(
            {
                "doc_id": i,
                "n_a": sum(len(x) for x, _ in found),
                "n_b": sum(len(y) for _, y in found),
                "n_groups": len(found),
                "n_links": len(pairs),
                "n_best": sum(count[k] == best[k[0]] for k in pairs),
                "count_sum": sum(count[k] for k in pairs),
                "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if found else "",
            }
        )
    return out


def sample(prose):
    r = random.Random(5)
    signs = list("ab c\t\n. é漢\U0001f600' \u0085‍") + ["  ", "    ", "<|endoftext|>", "</s>", "<0x41>", "don't ", "\r\n"]
    rows = [(i, "".join(r.choice(signs) for _ in range(r.randint(1, 30)))) for i in range(150)]
    rows += [(200 + i, " ".join(prose(i % 9, 60))) for i in range(20)]
    rows += [(300, None), (301, ""), (302, " "), (303, "x "), (304, " x"), (305, "a▁b"), (306, "漢" * 400), (307, "z" * 3000), (308, "-" * 999 + "é" * 999)]
    return rows + [(1, rows[1][1]), (None, "a null id"), (None, rows[160][1]), (309, "wide   gaps    and\n\n  lines " * 60)]


def test_against_bytes_of_whole_texts(docs, prose):
    rows = sample(prose)
    frame = docs(rows)
    key = lambda x: (str(x["doc_id"]), x["n_a"], x["groups_sha256"])
    found = sorted((r.asDict() for r in m.link_counts(frame).collect()), key=key)
    assert found == sorted(plain(rows), key=key)
    assert m.link_counts(docs([])).count() == 0


def test_chunks_give_the_groups_of_whole_texts(prose, monkeypatch):
    monkeypatch.setattr(m, "REMEMBERED", 100)
    monkeypatch.setattr(m, "SHORT", 12)
    chunks = m.Chunks(m.CharacterSpans(m.FIRST), m.ByteSpans(m.SECOND))
    assert chunks.cuts
    for _ in range(2):
        for i, text in sample(prose):
            numbers, keep = chunks.numbers([text or "", "of a text"])
            chunks.uses.room[: chunks.uses.size] += 1 + (i or 0) % 3
            found = m.groups_of(text, chunks)
            bad = any(chunks.sums.room[4 * x] < 0 for x in numbers[0])
            assert bad == (not found and bool(text))
            assert bad or ";".join(chunks.texts[x] for x in numbers[0]) == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for _, a, b in found)
            if not bad:
                place, _ = m.spread(chunks.begins.all(), np.array(numbers[0], np.int64))
                sums = chunks.sums.all().reshape(-1, 4)[numbers[0]].sum(axis=0) if numbers[0] else [0] * 4
                assert list(sums[:3]) == [sum(len(g[1]) for g in found), sum(len(g[2]) for g in found), len(found)]
                want = defaultdict(int)
                for _, a, b in found:
                    for x in a:
                        for y in b:
                            want[x << 32 | y] += 1
                got = defaultdict(int)
                for pair, n in zip(chunks.pairs.all()[place].tolist(), chunks.times.all()[place].tolist()):
                    got[pair] += n
                assert got == want and sums[3] == sum(want.values())
            chunks.drop(keep)
            assert len(chunks) == len(chunks.texts) == chunks.uses.size == keep


def test_long_stretches_without_a_common_cut(monkeypatch):
    chunks = m.chunks_of(m.FIRST, m.SECOND)
    g = chunks.spelt(" " + "zzé" * 40 + "漢字" * 10)
    few = sorted(zip(*(x.tolist() for x in m.links(g))))
    monkeypatch.setattr(m, "MANY", 1)
    many = defaultdict(int)
    for pair, n, group in few:
        many[pair, group] += n
    assert sorted((p, n, k) for (p, k), n in many.items()) == sorted(zip(*(x.tolist() for x in m.links(g))))


def test_spans_are_returned(docs):
    frame = docs([(1, "hello \U0001f600"), (2, None)])
    found = m.alignments(frame)
    assert found.columns == [*frame.columns, "groups"]
    rows = {r.doc_id: r.groups for r in found.collect()}
    assert rows[2] == [] and rows[1][-1]["end"] == len(" hello \U0001f600".encode())
    assert all(g["first"] and g["second"] for g in rows[1])
