"""Language identification by unigram piece models summed over all segmentations.

A word (letters only, lower case, behind a word mark) is generated as any sequence of pieces of a
fixed public vocabulary; the forward algorithm sums the probabilities of all of them. Each
language has its own piece probabilities, learnt by expectation-maximisation on word counts of at
most ``MOST_TEXTS`` labelled texts per language. A text's score for a language is the sum over all
its words, plus the language's share of the labelled texts.

The model is a table of vocabulary x languages numbers; it is all that reaches the driver.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every text
if nothing was learnt. Rows with a null label teach nothing. A null id counts as held out. Repeated
rows are rows of their own; ties go to the language first in name order; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import documents, land

MARK = "▁"
WORD = re.compile(r"[^\W\d_]+")
MOST_TEXTS = 1_500
ROUNDS = 3
SMOOTHING = 0.1
#: Words whose scores one worker keeps before it starts afresh.
KEPT = 1_500_000
UNSEEN = 1e-8
#: Letters of a word beyond which expectations are summed as logarithms.
LONG = 60


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces of letters, with or without a word mark before them."""
    model = sentencepiece.SentencePieceProcessor(
        model_file=path or public_tokenizers.path("piece_bpe_32k.model")
    )
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p.lower() for p in pieces if p == MARK or p.removeprefix(MARK).isalpha()})


@dataclass
class Lattice:
    """Piece ids of all substrings of words; two more ids mean an unseen letter and no piece."""

    pieces: list[str]
    ids: dict[str, int] = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))

    def of(self, words: list[str]) -> np.ndarray:
        """For words of one length: [word, end, piece length - 1] → piece id."""
        unseen, none = len(self.pieces), len(self.pieces) + 1
        n, get = len(words[0]), self.ids.get
        cuts = [(end, k) for end in range(1, n + 1) for k in range(1, min(end, self.longest) + 1)]
        parts = [slice(end - k, end) for end, k in cuts]
        found = np.array([[get(w[part], none) for part in parts] for w in words], np.int32)
        out = np.full((len(words), n, self.longest), none, np.int32)
        end, k = np.array(cuts).T - 1
        out[:, end, k] = found
        letters = out[:, :, 0]
        letters[letters == none] = unseen
        return out

    def forward(self, ids: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all segmentations of every prefix, scaled, and the log of the scale of the whole.

        ``table``: [piece id, language] → probability, with rows for an unseen letter and no piece.
        """
        words, n, _ = ids.shape
        sums = np.zeros((words, n + 1, table.shape[1]))
        sums[:, 0] = 1
        scale = np.zeros(words)
        for end in range(1, n + 1):
            for k in range(min(end, self.longest)):
                sums[:, end] += sums[:, end - 1 - k] * table[ids[:, end - 1, k]]
            small = sums[:, end].max(1) < 1e-120
            if small.any():
                low = max(0, end - self.longest)
                sums[small, low : end + 1] *= 1e120
                scale[small] -= 120 * np.log(10)
        return sums, scale

    def scores(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), table.shape[1]))
        for at in _by_length(words):
            sums, scale = self.forward(self.of([words[i] for i in at]), table)
            out[at] = np.log(np.maximum(sums[:, -1], 1e-300)) + scale[:, None]
        return out

    def expected(self, words: list[str], times: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece over all segmentations (one language)."""
        table = np.append(p, [UNSEEN, 0.0])[:, None]
        out = np.zeros(len(table))
        for at in _by_length(words):
            ids = self.of([words[i] for i in at])
            n = ids.shape[1]
            if n > LONG:
                out += self._expected_by_logs(ids, table[:, 0], times[at])
                continue
            ahead = self.forward(ids, table)[0][:, :, 0]
            behind = np.zeros_like(ahead)
            behind[:, n] = 1
            for start in range(n - 1, -1, -1):
                for k in range(min(n - start, self.longest)):
                    behind[:, start] += table[ids[:, start + k, k], 0] * behind[:, start + k + 1]
            share = times[at] / np.maximum(ahead[:, n], 1e-300)
            for end in range(1, n + 1):
                for k in range(min(end, self.longest)):
                    piece = ids[:, end - 1, k]
                    use = ahead[:, end - 1 - k] * table[piece, 0] * behind[:, end] * share
                    out += np.bincount(piece, use, len(out))
        return out[: len(p)]


    def _expected_by_logs(self, ids: np.ndarray, p: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The same for words so long that their probabilities fit no number: sums of logarithms."""
        words, n, longest = ids.shape
        with np.errstate(divide="ignore"):
            cost = np.log(p)[ids]  # by word, end and length
        ahead, behind = np.full((words, n + 1), -np.inf), np.full((words, n + 1), -np.inf)
        ahead[:, 0] = behind[:, n] = 0.0
        for end in range(1, n + 1):
            k = np.arange(min(end, longest))
            ahead[:, end] = np.logaddexp.reduce(ahead[:, end - 1 - k] + cost[:, end - 1, k], axis=1)
        for start in range(n - 1, -1, -1):
            k = np.arange(min(n - start, longest))
            behind[:, start] = np.logaddexp.reduce(cost[:, start + k, k] + behind[:, start + k + 1], axis=1)
        out = np.zeros(len(p))
        for end in range(1, n + 1):
            k = np.arange(min(end, longest))
            use = np.exp(ahead[:, end - 1 - k] + cost[:, end - 1, k] + behind[:, [end]] - ahead[:, [n]]) * times[:, None]
            out += np.bincount(ids[:, end - 1, k].ravel(), use.ravel(), len(out))
        return out


def _by_length(words: list[str], most: int = 2048) -> Iterator[np.ndarray]:
    """Positions of words of the same length, in bounded lots."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(group):
            lot = max(1, min(most, 100_000 // int(lengths[group[0]])))
            for i in range(0, len(group), lot):
                yield group[i : i + lot]


def words_of(text: str | None) -> list[str]:
    """Runs of letters. Numerals that are no digits (², ½, ①) are no letters either."""
    words = WORD.findall(text.lower()) if text else []
    if all(map(str.isalpha, words)):
        return words
    return [run for w in words for run in "".join(c if c.isalpha() else " " for c in w).split()]


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    table: np.ndarray  # [piece id, language], two more rows: an unseen letter, no piece
    pieces: list[str]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def word_counts(texts: DataFrame) -> DataFrame:
    """(label, word, n) of (label, text), counted in each batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.setdefault(label, Counter()).update(words_of(text))
            rows = [(label, w, n) for label, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                names=["label", "word", "n"],
            )

    return (
        texts.mapInArrow(run, "label string, word string, n long")
        .groupBy("label", "word")
        .agg(F.sum("n").alias("n"))
    )


def fit(
    labelled: DataFrame,
    label: str = "lang",
    text: str = "text",
    key: str = "doc_id",
    most_texts: int = MOST_TEXTS,
    rounds: int = ROUNDS,
    path: str | None = None,
) -> Model:
    """Learn from a sample, by a hash of the key, of about ``most_texts`` labelled texts of each language."""
    rows = labelled.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{text}`").alias("text")
    ).where("label IS NOT NULL AND text IS NOT NULL")
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    languages = sorted(totals)
    pieces = vocabulary(path)
    if not languages:
        return Model([], np.zeros(0), np.zeros((len(pieces) + 2, 0)), pieces)
    place = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.0)
    for name, n in totals.items():
        if n > most_texts:
            share = F.when(F.col("label") == name, F.lit(most_texts / n)).otherwise(share)
    counts = land(word_counts(rows.where(place < share).select("label", "text")), "words")
    lattice = Lattice(pieces)
    number = {p: i for i, p in enumerate(languages)}
    p = np.full((len(pieces), len(languages)), 1 / len(pieces))
    for _ in range(rounds):
        p = _improved(counts, p, lattice, number)
    table = np.vstack([p, np.full((1, len(languages)), UNSEEN), np.zeros((1, len(languages)))])
    all_texts = sum(totals.values())
    return Model(languages, np.log([totals[x] / all_texts for x in languages]), table, pieces)


def _improved(counts: DataFrame, p: np.ndarray, lattice: Lattice, number: dict[str, int]) -> np.ndarray:
    """One round: expected piece counts under ``p``, summed over the tasks, made probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(p)
        for batch in batches:
            labels, words, times = (c.to_pylist() for c in batch.columns)
            labels, times = np.array([number[x] for x in labels], np.int64), np.array(times, float)
            for k in set(labels.tolist()):
                mine = np.flatnonzero(labels == k)
                total[:, k] += lattice.expected([MARK + words[i] for i in mine], times[mine], p[:, k])
        piece, language = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language), pa.array(piece), pa.array(total[piece, language])],
            names=["language", "piece", "n"],
        )

    sums = (
        counts.mapInArrow(run, "language long, piece long, n double")
        .groupBy("language", "piece")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most vocabulary x languages rows
    )
    out = np.full(p.shape, SMOOTHING)
    out[sums["piece"], sums["language"]] += sums["n"]
    return out / out.sum(0)


class Scorer:
    """Word scores of one worker process, kept between batches and tasks of a model."""

    _last: Scorer | None = None

    @classmethod
    def of(cls, model: Model) -> Scorer:
        if cls._last is None or cls._last.model.name != model.name:
            cls._last = cls(model)
        return cls._last

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.seen: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        if len(self.seen) + len(words) > KEPT:
            self.seen, self.scores = {}, self.scores[:0]
        new = [w for w in words if w not in self.seen]
        if new:
            rows = self.lattice.scores([MARK + w for w in new], self.model.table)
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, rows])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for i in range(0, len(texts), 1000):
            split = [words_of(t) for t in texts[i : i + 1000]]
            if self.model.languages:
                self.learn(set().union(*split))
            at = self.seen.__getitem__
            for words in split:
                if not words or not self.model.languages:
                    out.append(("und", 0.0))
                    continue
                total = self.scores[np.fromiter(map(at, words), np.int64, len(words))].sum(0)
                total += self.model.log_prior
                best = int(total.argmax())
                out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def identify(docs: DataFrame, model: Model, carry: list[Column], text: str = "text") -> DataFrame:
    """The ``carry`` columns of every row with lang_pred and score of its whole text."""
    rows = docs.select(*carry, F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.of(model)
        for batch in batches:
            found = scorer.predict(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema]
    return rows.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def held_out(folds: int, fold: int, key: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text, modulo ``folds``; a null id is one."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % folds == fold, F.lit(True))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs.where(~held_out(4, 2)))
    return identify(docs, model, [F.col("doc_id"), held_out(4, 2).alias("held_out")])


QUERIES = {"op3_language_id": op3_language_id}
ORACLE: dict[str, str] = {}
