"""Alignment of two tokenizers' tokens over whole texts, by as-of joins on byte offsets.

Tokenizer A (byte-level pairs) sees a blank and the text, tokenizer B (pieces with byte fallback) the
text, before which it puts a blank itself. Both cover the same bytes. Per batch of documents, keyed by the
document, ``merge_asof`` finds for each token start the token of the other side that covers it; the
union of both directions is every overlapping pair, once. Offsets where tokens of both sides end cut
the tokens into groups.

Neither side's tokens cross from a letter to a blank, so a text is cut there into words, whose ids are
kept as words come again, and a long text is worked off in windows. Windows are dealt into lots of some
``LOT`` bytes. What a lot sends on to the corpus-wide counts is one row per different pair of ids, so a
pair that is everywhere costs one row a lot; the counts come back to the lot the same way.

Defined results: texts that are null, empty, or not covered by the bytes of both sides (a text with the
word mark itself) have no tokens; repeated rows and null ids count each as a document of their own; an
empty table gives no rows; other columns are not read. Memory follows the lot, and the longest run
without a blank, which is tokenized whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from arealis.llm.common import documents, land

MARK = "▁"
#: Characters of a window, and bytes after which a lot is full.
WINDOW, LOT = 200_000, 600_000
#: Words, and letters of words, whose ids one worker keeps before it starts afresh.
KEPT, KEPT_LETTERS = 600_000, 20_000_000
#: Blanks behind a letter, with something behind them: both tokenizers start a token there.
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")
#: A blank that follows other white space is no such place.
_ODD_BLANK = re.compile(r"[^\S ] ")
_ASCII_BLANKS = tuple(chr(c) + " " for c in (*range(0x09, 0x0E), *range(0x1C, 0x20)))


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _Kept:
    """Ids of all kept words on one side, end to end."""

    def __init__(self):
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.starts, self.sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(self, words: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        need = self.used + int(sizes.sum())
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(max(need, len(self.ids)), np.int32)])
        self.ids[self.used : need] = np.fromiter(chain.from_iterable(words), np.int32, need - self.used)
        self.starts = [np.concatenate([*self.starts, self.used + np.cumsum(sizes) - sizes])]
        self.sizes = [np.concatenate([*self.sizes, sizes])]
        self.used = need

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and how many each word has."""
        n = self.sizes[0][codes]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[0][codes] - ends + n, n) + np.arange(total)].astype(np.int64), n


class Sides:
    """Both tokenizers, the byte length of each id, and the ids of words met before."""

    _made: dict[tuple[str, str], Sides] = {}

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        spelt = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(spelt[c] for c in token) if all(c in spelt for c in token) else b""
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text, self.b_text = _spelt(len(self.a_bytes)), _spelt(len(self.b_bytes))
        self.forget()

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Sides:
        """One pair of tokenizers and one cache for each worker process."""
        key = (a_path, b_path)
        if key not in cls._made:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
            cls._made[key] = cls(a_path, b_path)
        return cls._made[key]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i):
            return b""
        return piece.replace(MARK, " ").encode()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.letters = 0
        self.kept_a, self.kept_b = _Kept(), _Kept()
        self.unlike = np.zeros(0, bool)

    def _learn(self, words: list[str]) -> None:
        """Ids of words not met before."""
        new = list(set(words).difference(self.code))
        if not new:
            return
        a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in new], add_special_tokens=False)]
        b = self.b.encode(new, num_threads=1)
        want = [(" " + w).encode() for w in new]
        unlike = np.zeros(len(new), bool)
        for ids, spelt in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(spelt.__getitem__, chain.from_iterable(ids))) != b"".join(want):
                unlike |= np.array([b"".join([spelt[i] for i in x]) != w for x, w in zip(ids, want)])
        self.unlike = np.concatenate([self.unlike, unlike])
        self.kept_a.add(a)
        self.kept_b.add(b)
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.letters += sum(map(len, new))

    def codes(self, words: list[str]) -> np.ndarray:
        """Numbers of the words, good until the next call."""
        if len(self.code) > KEPT or self.letters > KEPT_LETTERS:
            self.forget()
        self._learn(words)
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def covers(self, text: str) -> bool:
        """Whether the bytes of both sides' tokens are those of a blank and the text."""
        for window in windows(text):
            codes = self.codes(split(window))
            if self.unlike[codes].any():
                return False
        return True


def _spelt(size: int) -> np.ndarray:
    """Each id in decimal with ``,``, ``|`` or ``;`` behind it, as fixed-width bytes; row 3 * id + separator."""
    return np.array([f"{i}{s}".encode() for i in range(size) for s in ",|;"])


def windows(text: str) -> Iterator[str]:
    """The text in parts of some ``WINDOW`` characters, each without the blank before it."""
    at = 0
    while len(text) - at > WINDOW and (cut := _CUT.search(text, at + WINDOW)):
        yield text[at : cut.start()]
        at = cut.start() + 1
    yield text[at:]


def split(window: str) -> list[str]:
    """Words of a window, each without the blank before it."""
    words = window.split(" ")
    if "" in words or (_ODD_BLANK.search(window) if not window.isascii() else any(x in window for x in _ASCII_BLANKS)):
        return [w[1:] for w in _CUT.split(" " + window)]
    return words


class Lot:
    """Windows whose tokens are found together; offsets run on from one to the next."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.words: list[str] = []
        self.n_words: list[int] = []

    def add(self, window: str | None) -> None:
        words = split(window) if window else []
        self.words += words
        self.n_words.append(len(words))

    def aligned(self) -> Aligned:
        """Windows with a word that both sides don't cover have no tokens."""
        sides, windows_ = self.sides, len(self.n_words)
        codes, of = sides.codes(self.words), np.repeat(np.arange(windows_), self.n_words)
        unlike = np.bincount(of, sides.unlike[codes], windows_) > 0
        codes, of = codes[~unlike[of]], of[~unlike[of]]
        (a, n_a), (b, n_b) = sides.kept_a.of(codes), sides.kept_b.of(codes)
        n_a, n_b = (np.bincount(of, n, windows_).astype(np.int64) for n in (n_a, n_b))
        a_end, b_end = np.cumsum(sides.a_length[a]), np.cumsum(sides.b_length[b])
        return Aligned(sides, a, b, n_a, n_b, a_end, b_end)


@dataclass
class Aligned:
    sides: Sides
    a: np.ndarray  # ids
    b: np.ndarray
    n_a: np.ndarray  # tokens by window
    n_b: np.ndarray
    a_end: np.ndarray  # byte offsets
    b_end: np.ndarray

    def __post_init__(self):
        a, b = (
            pd.DataFrame({"doc": np.repeat(np.arange(len(n)), n), "start": end - length[ids], "token": np.arange(len(ids))})
            for n, end, length, ids in (
                (self.n_a, self.a_end, self.sides.a_length, self.a),
                (self.n_b, self.b_end, self.sides.b_length, self.b),
            )
        )
        over_a = pd.merge_asof(a[["doc", "start"]], b, on="start", by="doc")
        over_b = pd.merge_asof(b[["doc", "start"]], a.assign(begin=a["start"]), on="start", by="doc")
        # pairs whose starts are equal are met in the first direction already
        late = (over_b["begin"] != over_b["start"]).to_numpy()
        link_a = np.concatenate([a["token"].to_numpy(), over_b["token"].to_numpy()[late]]).astype(np.int64)
        link_b = np.concatenate([over_a["token"].to_numpy(), b["token"].to_numpy()[late]]).astype(np.int64)
        order = np.argsort(link_a + link_b, kind="stable")  # links go up on one side or the other
        self.link_a, self.link_b = link_a[order], link_b[order]
        self.n_links = np.bincount(a["doc"].to_numpy()[self.link_a], minlength=len(self.n_a))
        #: Whether tokens of both sides end where the token does, and the group of each token.
        place = np.searchsorted(self.b_end, self.a_end)
        self.a_last = self.b_end[place] == self.a_end if len(self.b_end) else np.zeros(0, bool)
        self.b_last = np.zeros(len(self.b), bool)
        self.b_last[place[self.a_last]] = True
        self.a_group, self.b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        ended = np.concatenate([[0], np.cumsum(self.a_last)])
        self.first_group = ended[np.concatenate([[0], np.cumsum(self.n_a)])]
        self.n_groups = np.diff(self.first_group)

    def spelt(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each window."""
        groups = int(self.first_group[-1])
        width = max(self.sides.a_text.itemsize, self.sides.b_text.itemsize)
        out = np.empty(len(self.a) + len(self.b), f"S{width}")
        a_in, b_in = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        out[np.arange(len(self.a)) + (np.cumsum(b_in) - b_in)[self.a_group]] = self.sides.a_text[3 * self.a + self.a_last]
        out[np.arange(len(self.b)) + np.cumsum(a_in)[self.b_group]] = self.sides.b_text[3 * self.b + 2 * self.b_last]
        at = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        return [out[i:j].tobytes().replace(b"\0", b"")[:-1] for i, j in zip(at, at[1:])]


def _lots(sides: Sides, rows: Iterator[tuple[object, str | None]]) -> Iterator[tuple[list[tuple], Aligned]]:
    """Lots as ((row number, id, whether it is the row's last window) of each window, tokens)."""
    lot, owners, held = Lot(sides), [], 0
    for number, (key, text) in enumerate(rows):
        # a text of several windows must be covered as a whole
        parts = windows(text or "") if len(text or "") <= WINDOW or sides.covers(text) else iter([None])
        now, more = next(parts), True
        while more:
            after = next(parts, sides)
            more = after is not sides
            lot.add(now)
            owners.append((number, key, not more))
            held += len(now or "") + 64
            now = after
            if held >= LOT:
                yield owners, lot.aligned()
                lot, owners, held = Lot(sides), [], 0
    if owners:
        yield owners, lot.aligned()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str | None]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i], batch.column(1)[i].as_py()


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return (
        a_path or public_tokenizers.path("byte_bpe_50k.json"),
        b_path or public_tokenizers.path("piece_bpe_32k.model"),
    )


def _input(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))


_TOKEN = "array<struct<id:int,start:bigint,end:bigint,part:int>>"


def align(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
) -> DataFrame:
    """Tokens, overlaps and groups themselves: one row per window of a document.

    ``row`` numbers the input rows, ``window`` the windows of a row (one but for long texts). Tokens have
    their id, byte offsets in the window and group; links are positions in ``a`` and ``b``.
    """
    paths = _paths(a_path, b_path)
    rows = _input(docs, id_column, text_column)
    schema = T.StructType([T.StructField("row", T.LongType()), rows.schema["id"]])
    for name, kind in (("window", "int"), ("a", _TOKEN), ("b", _TOKEN), ("links", "array<struct<a:int,b:int>>")):
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        before, window = None, 0
        for owners, found in _lots(Sides.of(*paths), _rows(batches)):
            sides = found.sides
            token = pa.struct([("id", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("part", pa.int32())])
            numbers = []
            for number, _, _ in owners:
                window = window + 1 if number == before else 0
                before = number
                numbers.append(window)
            columns = []
            starts = np.concatenate([[0], found.a_end])[np.cumsum(found.n_a) - found.n_a]
            for ids, end, n, length, group in (
                (found.a, found.a_end, found.n_a, sides.a_length, found.a_group),
                (found.b, found.b_end, found.n_b, sides.b_length, found.b_group),
            ):
                base_offset, base_group = np.repeat(starts, n), np.repeat(found.first_group[:-1], n)
                fields = [
                    pa.array(ids, pa.int32()), pa.array(end - length[ids] - base_offset), pa.array(end - base_offset),
                    pa.array(group - base_group, pa.int32()),
                ]
                values = pa.StructArray.from_arrays(fields, fields=list(token))
                columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), values))
            owner = np.repeat(np.arange(len(owners)), found.n_links)
            first_a, first_b = np.cumsum(found.n_a) - found.n_a, np.cumsum(found.n_b) - found.n_b
            pairs = pa.StructArray.from_arrays(
                [pa.array(found.link_a - first_a[owner], pa.int32()), pa.array(found.link_b - first_b[owner], pa.int32())], ["a", "b"]
            )
            links = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(found.n_links)]).astype(np.int32), pairs)
            keys = pa.array([k.as_py() for _, k, _ in owners], owners[0][1].type)
            rows_ = pa.array([base + n for n, _, _ in owners], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows_, keys, pa.array(numbers, pa.int32()), *columns, links],
                names=["row", "id", "window", "a", "b", "links"],
            )

    return rows.mapInArrow(run, schema)


def _reduced(docs: DataFrame, id_column: str, text_column: str, paths: tuple[str, str]) -> DataFrame:
    """Rows of windows, with their counts and links, and rows of the different pairs of each lot.

    A pair (a << 32 | b) has its ``place`` in the lot and the number of links that hold it; a window's
    ``links`` are such places. ``sha256`` is set on the last window of a document.
    """
    rows = _input(docs, id_column, text_column)
    schema = T.StructType([T.StructField("lot", T.LongType()), T.StructField("row", T.LongType()), rows.schema["id"]])
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("sha256", T.StringType()).add("links", T.ArrayType(T.IntegerType()))
    schema = schema.add("place", T.IntegerType()).add("pair", T.LongType()).add("count", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, key_type = TaskContext.get().partitionId() << 33, None

        def batch(n: int, lot: int, **columns: pa.Array) -> pa.RecordBatch:
            kinds = {"sha256": pa.string(), "links": pa.list_(pa.int32()), "place": pa.int32(), "id": key_type}
            all_ = {f: pa.nulls(n, kinds.get(f, pa.int64())) for f in schema.names} | {"lot": pa.array([base + lot] * n)} | columns
            return pa.RecordBatch.from_pydict(all_)

        before, digest, sides = None, hashlib.sha256(), Sides.of(*paths)
        for lot, (owners, found) in enumerate(_lots(sides, _rows(batches))):
            texts, key_type = [], owners[0][1].type
            for (number, _, last), part in zip(owners, found.spelt()):
                if number == before:
                    digest.update(b";")
                else:
                    before, digest = number, hashlib.sha256()
                digest.update(part)
                texts.append((digest.hexdigest() if part else "") if last else None)
            codes = found.a[found.link_a] << 32 | found.b[found.link_b]
            pairs, places, counts = np.unique(codes, return_inverse=True, return_counts=True)
            ends = np.concatenate([[0], np.cumsum(found.n_links)]).astype(np.int32)
            yield batch(
                len(owners), lot,
                row=pa.array([base + n for n, _, _ in owners], pa.int64()),
                id=pa.array([k.as_py() for _, k, _ in owners], key_type),
                **{n: pa.array(getattr(found, n), pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")},
                sha256=pa.array(texts, pa.string()),
                links=pa.ListArray.from_arrays(ends, pa.array(places.astype(np.int32))),
            )
            if len(pairs):
                yield batch(
                    len(pairs), lot,
                    place=pa.array(np.arange(len(pairs), dtype=np.int32)), pair=pa.array(pairs), count=pa.array(counts, pa.int64()),
                )
        sides.forget()  # a worker that waits for its next task holds no words

    return rows.mapInArrow(run, schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, total, best) over the corpus; ``best`` where no pair of the same B id has a higher total."""
    counts = land(pairs.groupBy("pair").agg(F.sum("count").alias("total")), "pair-counts")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
    highest = counts.groupBy(b).agg(F.max("total").alias("highest"))
    return counts.select("*", b).join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def summarised(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
) -> DataFrame:
    """Per document the numbers of tokens, groups and links, and what its links count corpus-wide."""
    rows = land(_reduced(docs, id_column, text_column, _paths(a_path, b_path)), "lots")
    pairs = rows.where("pair IS NOT NULL").select(F.col("lot").alias("of"), "place", "pair", "count")
    counts = land(pair_counts(pairs), "pairs")
    back = pairs.join(counts, "pair").select("of", "place", "total", "best")
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    windows_ = rows.where("row IS NOT NULL").select("lot", "row", "id", *numbers, "sha256", "links")
    schema = T.StructType([f for f in windows_.schema.fields if f.name not in ("lot", "links")])
    schema = schema.add("n_best", T.LongType()).add("count_sum", T.LongType())

    def run(some: pa.Table, known: pa.Table) -> pa.Table:
        value, best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        place = known.column("place").to_numpy()
        value[place], best[place] = known.column("total").to_numpy(), known.column("best").to_numpy()
        links = some.column("links").combine_chunks().flatten().to_numpy()
        at = np.concatenate([[0], np.cumsum(some.column("n_links").to_numpy())])
        columns = {n: some.column(n) for n in schema.names[:-2]}
        for name, x in (("n_best", best), ("count_sum", value)):
            columns[name] = pa.array(np.diff(np.concatenate([[0], np.cumsum(x[links])])[at]), pa.int64())
        return pa.table(columns)

    parts = windows_.groupBy("lot").cogroup(back.groupBy("of")).applyInArrow(run, schema)
    return (
        parts.groupBy("row")
        .agg(F.first("id").alias("id"), *(F.sum(n).alias(n) for n in (*numbers, "n_best", "count_sum")), F.max("sha256").alias("groups_sha256"))
        .drop("row")
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarised(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


QUERIES = {"op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment}
ORACLE: dict[str, str] = {}
