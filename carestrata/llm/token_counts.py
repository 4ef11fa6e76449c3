"""Token counts of a unigram tokenizer, without making tokens.

The vocabulary's pieces and scores come from a tokenizer file. An Aho-Corasick automaton lists all pieces that end at
each character; dynamic programming keeps the best score and its number of pieces for every end. The rules are those of
the unigram tokenizer: spaces become U+2581, and one is put in front unless there is one; a later piece
start wins only with a strictly greater score; a character that is no piece scores the least score less 10; with byte
pieces in the vocabulary it counts as its UTF-8 bytes, without them a run of such characters is one unknown piece.

Texts are cut in front of a run of spaces, and at line ends, where no piece can go over the cut; where the vocabulary has
such a piece, they aren't. A segment's count doesn't depend on its neighbours, so a task remembers counts of short ones
it has met (at most `REMEMBERED`, then it starts anew). Cases: a null or empty text has no pieces and score 0; a segment
of any length is worked on whole; repeated rows count alike; an empty table gives no rows; other columns stay, whatever
their names, but for the two new ones, which are replaced. Scores of the given vocabulary are whole numbers, so that no
tie depends on rounding.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.store import table, text_or_empty

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, NEWLINE = "▁", "\n"
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
PENALTY, REMEMBERED, SHORT = 10.0, 400_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that text may match, their scores, the score of an unknown character, and if bytes stand in for it."""

    pieces: tuple[tuple[str, float], ...]
    unknown: float
    bytes_too: bool


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """From a SentencePiece file; its scores are taken as the unigram scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    least = min(model.get_score(i) for i in ids)
    pieces = tuple((model.id_to_piece(i), model.get_score(i)) for i in plain)
    return Vocabulary(pieces, least - PENALTY, sum(map(model.is_byte, ids)) == 256)


class Segments(dict):
    """Number of pieces of each segment met; `scores` has their scores."""

    def __init__(self, counter: Counter) -> None:
        self.counter, self.scores = counter, {}

    def __missing__(self, segment: str) -> int:
        count, self.scores[segment] = self.counter.best(segment)
        self[segment] = count
        return count

    def total(self, segments: list[str]) -> tuple[int, float]:
        found = sum(map(self.__getitem__, segments)), sum(map(self.scores.__getitem__, segments))
        if max(map(len, segments), default=0) > SHORT:
            for segment in {s for s in segments if len(s) > SHORT}:
                del self[segment], self.scores[segment]
        if len(self) > REMEMBERED:
            self.clear()
            self.scores.clear()
        return found


@dataclass
class Counter:
    vocabulary: Vocabulary
    automaton: ahocorasick.Automaton = field(default_factory=ahocorasick.Automaton)

    def __post_init__(self) -> None:
        pieces = [p for p, _ in self.vocabulary.pieces]
        for piece, score in self.vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.segments = Segments(self)
        # a run of unknown characters may go over any place
        apart = self.vocabulary.bytes_too
        self.by_line = apart and not any(NEWLINE in p for p in pieces)
        self.by_space = (apart or SPACE in pieces) and not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def best(self, segment: str) -> tuple[int, float]:
        """Number of pieces and score of the best cut of one segment."""
        n = len(segment)
        ending: list[list] = [[] for _ in range(n + 1)]
        for end, piece in self.automaton.iter(segment):
            ending[end + 1].append(piece)
        score, count, open_run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            best, pieces, unknown, single = None, 0, False, False
            for length, value in ending[end]:  # the longest first
                total = score[end - length] + value
                if best is None or total > best:
                    best, pieces = total, count[end - length] + 1
                single = single or length == 1
            if not single:
                total = score[end - 1] + self.vocabulary.unknown
                if best is None or total > best:
                    best, unknown = total, True
                    if self.vocabulary.bytes_too:
                        pieces = count[end - 1] + len(segment[end - 1].encode())
                    else:
                        pieces = count[end - 1] + (not open_run[end - 1])
            score[end], count[end], open_run[end] = best, pieces, unknown
        return count[n], score[n]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        text = text if text[0] == SPACE else SPACE + text
        lines = text.split(NEWLINE) if self.by_line else [text]
        count, score = len(lines) - 1, self.vocabulary.unknown * (len(lines) - 1)
        for line in lines:
            if line:
                n, s = self.segments.total(SEGMENT.findall(line) if self.by_space else [line])
                count, score = count + n, score + s
        return count, score


@lru_cache(maxsize=2)
def counter_of(vocabulary: Vocabulary) -> Counter:
    return Counter(vocabulary)


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`docs` with `n_tokens` and the `score` of the best cut of each whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file's vocabulary, whatever the corpus' size

    @F.arrow_udf("struct<n_tokens:long,score:double>")
    def count(texts: pa.Array) -> pa.Array:
        counter = counter_of(sent.value)
        found = [counter.text(t or "") for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], ["n_tokens", "score"]
        )

    counted = docs.withColumn("n_tokens", count(text_or_empty()))
    others = [c for c in docs.columns if c not in ("n_tokens", "score")]
    return counted.select(*others, F.col("n_tokens.n_tokens").alias("n_tokens"), F.col("n_tokens.score").alias("score"))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, read_vocabulary()).drop("text")
