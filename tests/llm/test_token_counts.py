import random
from pathlib import Path

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from carestrata.llm import token_counts as m


def reference(pieces, byte_fallback=False):
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=m.SPACE, prepend_scheme="always", split=False)
    return t


@pytest.mark.parametrize("seed", range(40))
def test_counts_with_many_ties(seed):
    r = random.Random(seed)
    made = {"".join(r.choice("ab" + m.SPACE) for _ in range(r.randint(1, 4))) for _ in range(12)}
    pieces = [("<unk>", 0.0)] + [(p, float(-r.randint(1, 4))) for p in sorted(made)]
    theirs = reference(pieces)
    mine = m.Counter(m.Vocabulary(tuple(pieces[1:]), min(s for _, s in pieces) - m.PENALTY, False))
    for _ in range(40):
        text = "".join(r.choice("abcd  \n") for _ in range(r.randint(0, 14)))
        assert mine.text(text)[0] == len(theirs.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("seed", range(10))
def test_score_is_the_best_of_all_cuts(seed):
    r = random.Random(seed)
    pieces = {"".join(r.choice("ab") for _ in range(r.randint(1, 3))): float(-r.randint(1, 5)) for _ in range(6)}
    counter = m.Counter(m.Vocabulary(tuple(pieces.items()), -20.0, False))

    def best(word):
        if not word:
            return 0.0
        ways = [pieces[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in pieces]
        return max(ways + ([-20.0 + best(word[1:])] if word[0] not in pieces else []))

    for _ in range(20):
        word = "".join(r.choice("abc") for _ in range(r.randint(1, 8)))
        assert counter.best(word)[1] == best(word)


@pytest.mark.skipif(not Path(m.VOCABULARY).exists(), reason="needs the vocabulary file")
def test_given_vocabulary(docs, prose):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=m.VOCABULARY)
    theirs = reference([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], True)
    texts = [" ".join(prose(i, 50)) for i in range(20)]
    texts += ["def f():\n        return 1", "a" + " " * 16 + "b", " " * 40, "x\n\n    y\n  ", "  a   b    c     d "]
    texts += [None, "", " ", "\n", "\n a", "  two  spaces ", "漢字 \U0001f600\U0001f600 x▁y", "\ttab\r\n", "z" * 5000, texts[0]]
    found = m.token_counts(docs(list(enumerate(texts))), m.read_vocabulary())
    assert found.columns == [c for c in docs([]).columns if c != "score"] + ["n_tokens", "score"]
    for r in found.collect():
        assert r.n_tokens == len(theirs.encode(r.text or "", add_special_tokens=False).ids)
    assert m.token_counts(docs([]), m.read_vocabulary()).count() == 0


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(m, "REMEMBERED", 3)
    counter = m.Counter(m.Vocabulary((("a", -1.0), ("▁", -1.0)), -20.0, False))
    assert counter.text("a aa aaa aaaa aaaaa")[0] == 20
    assert not counter.segments and not counter.segments.scores
    assert counter.text("a" * 100)[0] == 101 and not counter.segments


@pytest.mark.skipif(not Path(m.VOCABULARY).exists(), reason="needs the vocabulary file")
def test_pieces_of_several_spaces():
    counter = m.counter_of(m.read_vocabulary())
    assert counter.text("def f():\n        return 1")[0] == 9 and counter.text("a" + " " * 16 + "b")[0] == 3
