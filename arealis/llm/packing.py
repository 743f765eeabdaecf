"""Best-fit packing of tokenised documents into sequences of fixed capacity.

The histogram of piece lengths (at most ``capacity`` numbers) is all that leaves the executors.
On it the configuration linear program (fewest sequences that hold every piece, a column for
each way to fill one) is solved by multiplicative weights: every length has a price, a knapsack
dynamic program finds the dearest fillings, these get whole multiplicities, and lengths that lag
behind become dearer. What rounding leaves is packed best-fit, again on counts. The plan (its size
is bounded by capacity and rounds, not by the data) maps the n-th piece of a length to a sequence
and an offset, so no group of pieces is ever gathered: ranks are counted in salted buckets.

Defined results: a null or empty text is one piece with the closing id alone; a longer document is
cut into pieces of ``capacity`` ids; repeated rows are documents of their own; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealis.llm.common import content, documents, land
from arealis.llm.wordbpe import WordBpe, tokenizer_path

CAPACITY = 4096
CLOSING_ID = 1
ROUNDS = 80

Filling = tuple[tuple[int, int], ...]  # (length, copies), longest first


def pieces(
    docs: DataFrame, path: str, capacity: int, closing: int, id_column: str, text_column: str, with_ids: bool
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.of(path)
        try:
            for batch in batches:
                yield cut(bpe, batch)
        finally:
            bpe.forget()  # workers outlive their tasks

    def cut(bpe: WordBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        at, number, crc, size, kept = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            ids = bpe.ids(text) + end
            for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[start : start + 4 * capacity]
                at.append(i)
                number.append(k)
                size.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    kept.append(np.frombuffer(part, "<i4"))
        piece = pa.array(number, pa.int32())
        columns = [
            batch.column(0).take(pa.array(at, pa.int64())),
            piece,
            pa.array(np.array(number, np.int64) * capacity),
            pa.array(size, pa.int64()),
            pa.array(crc, pa.int64()),
        ]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(kept, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), content(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for each capacity, sizes falling; the size taken last there (0: none)."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(-sizes, -np.arange(capacity + 1))  # sizes fall: those that fit form the tail
    for room in range(int(sizes[-1]), capacity + 1):
        some = sizes[fits[room] :]
        values = best[room - some] + prices[fits[room] :]
        i = int(values.argmax())
        best[room], taken[room] = values[i], some[i]
    return best, taken


def priced_fillings(
    counts: np.ndarray, capacity: int, rounds: int = ROUNDS, rate: float = 0.5
) -> tuple[list[tuple[Filling, int]], np.ndarray]:
    """Fillings with their multiplicities, and the counts that rounding leaves over."""
    left, found = counts.copy(), Counter()
    weight = np.ones(capacity + 1)
    for step in range(rounds):
        sizes = np.flatnonzero(left)[::-1]
        if not len(sizes):
            break
        prices = sizes * weight[sizes]
        best, taken = _knapsack(sizes, prices, capacity)
        value = prices + best[capacity - sizes]
        placed = 0
        for i in np.argsort(-value, kind="stable"):
            filling, room = [int(sizes[i])], capacity - int(sizes[i])
            while taken[room]:
                filling.append(int(taken[room]))
                room -= filling[-1]
            if room > step:  # loose fillings are left to best fit until nothing closer is found
                continue
            parts = Counter(filling)
            times = min(int(left[s]) // n for s, n in parts.items())
            if times > 1 and step < rounds // 2:
                times = (times + 1) // 2  # the rest waits for the next prices
            if times:
                for s, n in parts.items():
                    left[s] -= times * n
                found[tuple(sorted(parts.items(), reverse=True))] += times
                placed += times
        lag = left[sizes] / counts[sizes]
        weight[sizes] *= np.exp(rate * (lag - lag.mean()) / (step + 1))
        if not placed and step > rounds // 2:
            break
    return list(found.items()), left


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on counts: alike sequences are filled together."""
    open_by_room: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(filling: Filling, room: int, times: int) -> None:
        if times:
            if room not in open_by_room:
                open_by_room[room] = []
                insort(rooms, room)
            open_by_room[room].append((filling, times))

    for size in np.flatnonzero(left)[::-1].tolist():
        n = int(left[size])
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                filling, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
            else:
                filling, room, times = (), capacity, -(-n // (capacity // size))
            each = room // size
            full = min(times, n // each)
            put((*filling, (size, each)), room - each * size, full)
            n -= full * each
            if full < times and n:
                put((*filling, (size, n)), room - n * size, 1)
                full, n = full + 1, 0
            if filling:
                put(filling, room, times - full)
    merged: Counter = Counter()
    for group in open_by_room.values():
        for filling, times in group:
            merged[filling] += times
    return list(merged.items())


def fewest(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """The rounded program with best fit for its rest; plain best fit where that takes fewer sequences."""
    fillings, left = priced_fillings(counts, capacity)
    return min(fillings + best_fit(left, capacity), best_fit(counts, capacity), key=lambda f: sum(n for _, n in f))


def plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, first sequence, copies in each, offset), sorted; the number of sequences."""
    used, rows, sequence = np.zeros(capacity + 1, np.int64), [], 0
    for filling, times in fewest(counts, capacity):
        offset = 0
        for size, copies in filling:
            rows.append((size, int(used[size]), sequence, copies, offset))
            used[size] += times * copies
            offset += size * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5), sequence


def ranked(parts: DataFrame, total: int, tie: str = "piece") -> DataFrame:
    """``rank`` from 0 among rows of the same length; salted, so a common length is no hot spot."""
    buckets = max(1, math.isqrt(total) // 4)  # neither buckets nor their number outgrow a task
    rows = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", tie, "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    here = Window.partitionBy("length", "bucket").orderBy("doc_id", tie, "ids_crc32")
    return (
        rows.withColumn("rank", F.row_number().over(here) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("bucket", "before")
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    closing: int = CLOSING_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked, ids."""
    path = tokenizer or tokenizer_path()
    parts = land(pieces(docs, path, capacity, closing, id_column, text_column, with_ids), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in parts.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    table, _ = plan(counts, capacity)
    placed = ranked(parts, int(counts.sum()))
    order = placed.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(order.index(c)).to_numpy() for c in ("length", "rank"))
            at = table[np.searchsorted(edges, (length.astype(np.int64) << 48) + rank, "right") - 1]
            sequence, slot = np.divmod(rank - at[:, 1], at[:, 3]) if len(rank) else (rank, rank)
            columns = [c for c, n in zip(batch.columns, order) if n != "rank"]
            names = [n for n in order if n != "rank"] + ["sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(at[:, 2] + sequence), pa.array(at[:, 4] + slot * length)], names=names
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.drop("rank").schema)
    return placed.mapInArrow(place, kinds + ", sequence_id long, offset long")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
ORACLE: dict[str, str] = {}
