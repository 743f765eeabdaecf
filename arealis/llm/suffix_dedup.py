"""Removal of byte strings that an earlier document has (suffix-array dedup).

Every byte covered by a string of ``SPAN`` bytes that also starts in a document with a smaller id is removed.
A column-wise construction over whole documents needs as many rounds as the longest has bytes, each over the
whole collection, so it runs on small collections that hold everything that can match:

1. Each start of ``SPAN`` bytes is named by the least hash of the 12-byte strings within it; starts in a row with
   the same name form a segment. Equal strings have equal names wherever they stand, so a name's segments can
   only match one another. Within a lot of documents, copies of a segment are removed where they
   stand and only the first one's is sent on, so a passage that many documents share stays small.
2. Segments are dealt out by name. Equal segments are settled by comparing bytes. Segments that share some string
   but differ (found by hashes, which never miss an equal pair) become a collection: their
   transform and common prefixes, built one symbol of each segment a round, show which strings of ``SPAN`` bytes
   are equal, byte by byte, and the smallest document that has each.
3. The spans of a document are gathered, merged and cut out of its text.

Defined results: a null text is empty; matches never cross documents; repeated rows are one document and not
matched with each other; rows without an id are neither compared nor cut; an empty table gives no rows;
other columns are not read. Ids are integers.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import content, documents, land
from arealis.llm.suffix_array import collection

SPAN = 50
GRAM = 12
WINDOW = SPAN - GRAM + 1
#: Starts that one segment has at most.
LONGEST = 64
#: Bytes of text whose segments are compared before they are sent.
LOT = 4_000_000
#: Bytes of text behind one bucket; its segments take about 3.5 times as much.
BUCKET = 1_500_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number."""
    out = raw.astype(np.uint64)
    for bits in (1, 2, 4):
        out = out[:-bits] | (out[bits:] << np.uint64(8 * bits))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _C
    x ^= x >> np.uint64(29)
    return x


def _grams(words: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each place."""
    later = words[GRAM - 8 :]
    return _mixed(words[: len(later)] * _A + (later ^ (later >> np.uint64(29))) * _B)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, … (counts[0] of them), starts[1], …"""
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(int(counts.sum()))


def segments(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, number of starts and name of each segment of the texts that end at ``ends``."""
    if len(raw) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _grams(_words(raw))
    width = 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[: width - WINDOW], least[WINDOW - width :])
    whole = np.ones(len(least), bool)  # starts whose string lies in one text
    for k in ends.tolist():
        whole[max(0, k - SPAN + 1) : k] = False
    same = whole[1:] & whole[:-1] & (least[1:] == least[:-1])
    begin = np.flatnonzero(whole & np.append(True, ~same))
    count = np.flatnonzero(whole & np.append(~same, True)) + 1 - begin
    if len(count) and count.max() > LONGEST:
        parts = -(-count // LONGEST)
        step = _spread(np.zeros(len(parts), np.int64), parts) * LONGEST
        begin, count = np.repeat(begin, parts) + step, np.minimum(np.repeat(count, parts) - step, LONGEST)
    return begin, count, least[begin]


def _numbered(keys: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(k, len(seen)) for k in keys], np.int64)


def _runs(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the same owner that touch or overlap, merged; sorted, with rising ends, on entry."""
    if not len(start):
        return owner, start, end
    new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > end[:-1]))
    return owner[new], start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def _packed(*parts: bytes) -> bytes:
    body = b"".join(struct.pack("<q", len(p)) + p for p in parts)
    return zstandard.ZstdCompressor(level=3).compress(body)


def _unpacked(blob: bytes) -> list[bytes]:
    body, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(body):
        size = struct.unpack_from("<q", body, at)[0]
        out.append(body[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def _lot(ids: list[int], texts: list[bytes], buckets: int) -> list[tuple[int, bytes]]:
    """(bucket, packed segments) of a lot; bucket -1: spans that the lot itself removes."""
    raw = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    place, count, name = segments(np.frombuffer(raw, np.uint8), ends)
    if not len(place):
        return []
    keys = [raw[a:b] for a, b in zip(place.tolist(), (place + count + SPAN - 1).tolist(), strict=True)]
    text = np.searchsorted(ends, place, "right")
    doc, at = np.array(ids, np.int64)[text], place - (ends - sizes)[text]
    same = _numbered(keys)
    first = np.full(same.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, same, doc)
    gone = doc > first[same]
    out = []
    who, start, end = _runs(text[gone], at[gone], (at + count + SPAN - 1)[gone])
    if len(who):
        out.append((-1, _packed(np.array(ids, np.int64)[who].tobytes(), start.tobytes(), end.tobytes())))
    bucket = (name % np.uint64(buckets)).astype(np.int64)
    sent = np.flatnonzero(~gone)
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    for group in np.split(sent, np.flatnonzero(np.diff(bucket[sent])) + 1):
        if len(group):
            step = np.diff(doc[group], prepend=0)
            columns = (
                step.tobytes(), at[group].astype("<i4").tobytes(), count[group].astype("<u2").tobytes(),
                (name[group] >> np.uint64(32)).astype("<u4").tobytes(),
            )
            out.append((int(bucket[group[0]]), _packed(*columns, b"".join([keys[i] for i in group.tolist()]))))
    return out


def _matches(doc: np.ndarray, at: np.ndarray, count: np.ndarray, name: np.ndarray, raw: bytes) -> tuple[np.ndarray, ...]:
    """(document, start, end) of all spans that a smaller document in the bucket has.

    ``name`` is half of a segment's name: what it brings together too much is told apart later.
    """
    size = count + SPAN - 1
    stop = np.cumsum(size)
    place = stop - size
    keys = [raw[a:b] for a, b in zip(place.tolist(), stop.tolist(), strict=True)]
    same = _numbered(keys)
    kinds = same.max() + 1
    first, last, one = np.full(kinds, np.iinfo(np.int64).max), np.full(kinds, np.iinfo(np.int64).min), np.zeros(kinds, np.int64)
    np.minimum.at(first, same, doc)
    np.maximum.at(last, same, doc)
    one[same] = np.arange(len(same))
    gone = doc > first[same]
    found = [(doc[gone], at[gone], (at + size)[gone])]

    rest = np.flatnonzero(~gone)
    rest = rest[np.argsort(same[rest], kind="stable")]
    kinds_of_rest = same[rest]
    for kind, low, high in _differing(name[one], count[one], first, last, [keys[i] for i in one.tolist()]):
        here = slice(*np.searchsorted(kinds_of_rest, [kind, kind + 1]))
        for i in rest[here].tolist():
            found.append((np.repeat(doc[i], len(low)), at[i] + low, at[i] + high))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _differing(
    name: np.ndarray, count: np.ndarray, first: np.ndarray, last: np.ndarray, keys: list[bytes]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For distinct segments that share a string with another, smaller one: (segment, starts, ends) to remove."""
    order = np.argsort(name, kind="stable")
    heads = np.flatnonzero(np.append(True, name[order][1:] != name[order][:-1]))
    low, high = np.minimum.reduceat(first[order], heads), np.maximum.reduceat(last[order], heads)
    members = np.diff(np.append(heads, len(order)))
    open_ = np.repeat((low < high) & (members > 1), members)
    rows = order[open_]
    if not len(rows):
        return
    words = _words(np.frombuffer(b"".join([keys[i] for i in rows.tolist()]), np.uint8))
    size = count[rows] + SPAN - 1
    start = _spread(np.cumsum(size) - size, count[rows])
    whole = words[start]
    for shift in (8, 16, 24, 32, 40, SPAN - 8):
        whole = _mixed(whole * _A + words[start + shift] * _B)
    owner = np.repeat(rows, count[rows])
    order = np.argsort(whole, kind="stable")
    heads = np.flatnonzero(np.append(True, whole[order][1:] != whole[order][:-1]))
    owners = owner[order]
    shared = np.minimum.reduceat(owners, heads) < np.maximum.reduceat(owners, heads)
    touched = np.unique(owners[np.repeat(shared, np.diff(np.append(heads, len(order))))])
    if not len(touched):
        return
    number, begin, common = collection([keys[i] for i in touched.tolist()], SPAN)
    lengths = count[touched] + SPAN - 1
    heads = np.flatnonzero(common < SPAN)
    smallest = np.minimum.reduceat(first[touched][number], heads)
    smallest = np.repeat(smallest, np.diff(np.append(heads, len(number))))
    mine = first[touched][number]
    cut = (begin + SPAN <= lengths[number]) & (smallest < mine)
    number, begin = number[cut], begin[cut]
    order = np.lexsort((begin, number))
    who, low, high = _runs(number[order], begin[order], begin[order] + SPAN)
    for group in np.split(np.arange(len(who)), np.flatnonzero(np.diff(who)) + 1):
        if len(group):
            yield int(touched[who[group[0]]]), low[group], high[group]


def _send(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size, out = [], [], 0, []
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for i, (doc, text) in enumerate(rows):
                ids.append(doc)
                texts.append(text.encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size >= LOT or i == len(rows) - 1:
                    out += _lot(ids, texts, buckets)
                    ids, texts, size = [], [], 0
            # spans that need no other lot go wherever there is room
            spots = [b if b >= 0 else rows[0][0] % buckets for b, _ in out]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(spots, pa.int64()),
                    pa.array([b < 0 for b, _ in out], pa.bool_()),
                    pa.array([x for _, x in out], pa.binary()),
                ],
                names=["bucket", "settled", "blob"],
            )

    return run


def _receive(table: pa.Table) -> pa.Table:
    found, doc, at, count, name, raw = [], [], [], [], [], []
    for settled, blob in zip(table.column("settled").to_pylist(), table.column("blob"), strict=True):
        parts = _unpacked(blob.as_py())
        if settled:
            found.append(tuple(np.frombuffer(p, np.int64) for p in parts))
        else:
            doc.append(np.cumsum(np.frombuffer(parts[0], np.int64)))
            at.append(np.frombuffer(parts[1], "<i4").astype(np.int64))
            count.append(np.frombuffer(parts[2], "<u2").astype(np.int64))
            name.append(np.frombuffer(parts[3], "<u4"))
            raw.append(parts[4])
    if doc:
        found.append(_matches(*map(np.concatenate, (doc, at, count, name)), b"".join(raw)))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    return pa.table(dict(zip(("id", "start", "end"), map(pa.array, columns), strict=True)))


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, start, end) of bytes to remove; spans of a document may overlap."""
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), content(text_column).alias("text")).where(
        "id IS NOT NULL"
    )
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    return (
        texts.mapInArrow(_send(buckets), "bucket long, settled boolean, blob binary")
        .groupBy("bucket")
        .applyInArrow(_receive, "id long, start long, end long")
    )


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_without(*row) for row in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            columns = [pa.array([row[k] for row in out], kind) for k, (_, kind) in enumerate(_CUT[:-1])]
            if with_text:
                columns.append(pa.array([row[4].decode("utf-8", "replace") for row in out], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["id", *(name for name, _ in _CUT[: len(columns)])]
            )

    return run


def _without(text: str, starts: list[int] | None, ends: list[int] | None) -> tuple[int, int, int, str, bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    kept, removed, spans = raw, 0, 0
    if starts:
        low, high = np.array(starts), np.array(ends)
        order = np.argsort(low, kind="stable")
        low, high = low[order], np.maximum.accumulate(high[order])
        _, low, high = _runs(np.zeros(len(low), np.int64), low, high)
        edges = [0, *np.stack([low, high], 1).ravel().tolist(), len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        removed, spans = int((high - low).sum()), len(low)
    return len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept


_CUT = (
    ("n_bytes", pa.int64()),
    ("n_removed", pa.int64()),
    ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()),
    ("kept_text", pa.string()),
)


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept_text.

    ``kept_text`` shows bytes of a character that was cut in two as the replacement character.
    """
    spans = (
        land(repeated_spans(docs, id_column, text_column), "spans")
        .groupBy("id")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    )
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), content(text_column).alias("text"))
    kinds = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.join(spans, "id", "left").mapInArrow(_cut(with_text), kinds + ", kept_text string" * with_text)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), with_text=False).withColumnRenamed("id", "doc_id")


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLE: dict[str, str] = {}
