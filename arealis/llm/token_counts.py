"""Token counts of whole texts under a unigram vocabulary: Viterbi without building the tokens.

An Aho-Corasick automaton over the vocabulary gives all pieces that end at each place of a word; the
dynamic program carries the best score and the number of pieces, nothing else. Ties are the
tokenizer's own: of equal scores the piece that starts first wins. A letter that is no piece costs
10 less than the lowest score, and neighbouring unknown letters are one token.

Blanks become word marks and every word starts with one, so words are counted apart; their counts
are kept, as words come again.

Pieces and scores are those of a public vocabulary file, whose path is a parameter (control, byte
and unused entries are no pieces).

Defined results: a null or empty text has 0 tokens; repeated rows count each; null ids are kept; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import content, documents

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts one worker keeps before it starts afresh.
KEPT = 2_000_000


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score); more than one mark in a row isn't met within a word, so such pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(
        model_file=path or public_tokenizers.path("piece_bpe_32k.model")
    )
    out = []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)):
            piece = model.id_to_piece(i)
            if MARK not in piece[1:]:
                out.append((piece, float(model.get_score(i))))
    return out


class Counter(dict):
    """Tokens of a word that starts with a mark."""

    _made: dict[int, Counter] = {}

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    @classmethod
    def of(cls, pieces: list[tuple[str, float]]) -> Counter:
        """One automaton and one cache for each vocabulary and worker process."""
        key = hash(tuple(pieces))
        if key not in cls._made:
            cls._made[key] = cls(pieces)
        return cls._made[key]

    def __missing__(self, word: str) -> int:
        marked = MARK + word
        known = self.single.issuperset(marked)
        n = self[word] = self.known_letters(marked) if known else self.any_letters(marked)
        return n

    def known_letters(self, word: str) -> int:
        """Tokens of the best segmentation; every letter is a piece. Matches come longest first."""
        score, count = [float("-inf")] * (len(word) + 1), [0] * (len(word) + 1)
        score[0] = 0.0
        for end, (length, gain) in self.automaton.iter(word):
            start = end + 1 - length
            value = score[start] + gain
            if value > score[end + 1]:
                score[end + 1] = value
                count[end + 1] = count[start] + 1
        return count[-1]

    def any_letters(self, word: str) -> int:
        ends: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        score, count, unknown = [0.0], [0], [False]
        for end, matches in enumerate(ends, 1):
            best, number, lost = float("-inf"), 0, False
            for length, gain in matches:
                value = score[end - length] + gain
                if value > best:
                    best, number, lost = value, count[end - length] + 1, False
            if word[end - 1] not in self.single and score[end - 1] + self.unknown > best:
                best, number, lost = score[end - 1] + self.unknown, count[end - 1] + (not unknown[end - 1]), True
            score.append(best)
            count.append(number)
            unknown.append(lost)
        return count[-1]

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        if len(self) > KEPT:
            self.clear()
        # a mark in the text is a blank; a first blank is the mark of the first word
        return sum(map(self.__getitem__, text.replace(MARK, " ").removeprefix(" ").split(" ")))


def count_tokens(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None
) -> DataFrame:
    """id, n_tokens of every whole text."""
    pieces = vocabulary(path)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), content(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(pieces)
        for batch in batches:
            counts = [counter.tokens(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["id", "n_tokens"])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("n_tokens", T.LongType())]))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


QUERIES = {"op10_token_counts": op10_token_counts}
ORACLE: dict[str, str] = {}
