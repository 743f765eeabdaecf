"""MinHash near-deduplication with tensored banding; links are confirmed on whole shingle sets.

Two small collections of ``BANDS`` half keys (two minhashes each) are computed; a table key is a pair
of half keys, one from each collection, so 64 minhashes serve 256 tables. A pair of texts with
similarity s meets in some table with probability (1 - (1 - s²)^16)², which is 1 - 4e-6 at 0.75.
A table key can only be shared where both halves are, so half keys that no other text has are
dropped before pairs are formed.

Texts with equal sets are one class from the start. In a table's bucket every class is compared with
the smallest one (a star). In buckets that still show several components, classes outside the largest are
compared with one member of it, a few times over, and in the last turn with all classes of other components. So a group of copies costs links in proportion to its size, and no link
between components is lost. There a pair also needs room for its intersection: hashes fall into ``BLOCKS``
blocks, and the lesser of both sets' counts, summed over the blocks, is at least the size of the intersection.
A pair goes on to its whole sets if its sizes allow the similarity and at
least ``LEAST_EQUAL`` of its 64 minhashes agree (at similarity 0.75 fewer agree once in 5 million). For that
16 bits of each minhash are kept, a quarter of the bytes: unequal ones that look equal let a pair through to
its sets. Landed steps are emptied once nothing reads them.

Defined results: null and blank texts have no shingles and are linked with nothing; fewer than five
words are one shingle; rows without an id are not linked and stay; repeated rows are equal texts;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm import common
from arealis.llm.common import content, documents, release
from arealis.llm.graph import components, linked

WORDS = 5
BANDS = 16
HASHES = 4 * BANDS
LEAST_EQUAL = 31
#: Per cent.
SIMILAR = 75
#: Turns on buckets that show several components; the last one leaves no pair out.
TURNS = 5
#: Blocks (a power of two) in which the hashes of a set are counted.
BLOCKS = 128
#: Word hashes one task keeps before it starts afresh.
KEPT = 300_000
#: Bytes of texts or sets that a worker is handed at once.
BATCH = "12m"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(5).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def land(df: DataFrame, name: str) -> DataFrame:
    """As :func:`arealis.llm.common.land`, with batches of ``BATCH`` bytes to the workers."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, BATCH)
    try:
        return common.land(df, name)
    finally:
        conf.set(key, before)


class Shingler(dict):
    """Distinct hashes (64 bits) of the five-word shingles of a text."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        # on bytes, lower() and split() know ASCII letters and blanks only
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < WORDS:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        if len(self) > KEPT:
            self.clear()
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        n = len(hashes) - WORDS + 1
        out = np.zeros(n, np.uint64)
        for i in range(WORDS):
            out = (out ^ hashes[i : i + n]) * _MIX
            out ^= out >> np.uint64(29)
        return np.unique(out)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[i : i + 4096, None] * _FACTORS).min(0))
    return least.view(np.int64)


def half_keys(sig: np.ndarray) -> np.ndarray:
    """A hash of every band's two minhashes and of its number."""
    two = sig.view(np.uint64).reshape(2 * BANDS, 2)
    out = (two[:, 0] ^ np.arange(1, 2 * BANDS + 1, dtype=np.uint64)) * _MIX
    out = ((out ^ (out >> np.uint64(31))) + two[:, 1]) * _MIX
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def block_counts(shingles: np.ndarray) -> np.ndarray | None:
    """Number of hashes in each block, by their highest bits; None if some block has more than 127."""
    blocks = shingles.view(np.uint64) >> np.uint64(65 - BLOCKS.bit_length())
    counts = np.bincount(blocks.astype(np.int64), minlength=BLOCKS)
    return counts.astype(np.int8) if counts.max() <= 127 else None


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        sizes, digests, halves, shorts = [], [], [], []
        for text in batch.column(1).to_pylist():
            some = shingler.of(text)
            sig = minhashes(some) if len(some) else None
            sizes.append(len(some))
            digests.append(xxhash.xxh128_digest(some.tobytes()) if len(some) else None)
            halves.append(half_keys(sig) if len(some) else None)
            shorts.append(sig.view(np.int16)[::4] if len(some) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(halves, pa.list_(pa.int64())), pa.array(shorts, pa.list_(pa.int16())),
            ],
            names=["id", "n", "digest", "halves", "sig"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        sets = [shingler.of(t).view(np.int64) for t in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(sets, pa.list_(pa.int64())), pa.array(map(block_counts, sets), pa.list_(pa.int8()))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "shingles", "blocks"])


def _confirmed(x: str, y: str) -> F.Column:
    """Whole sets are similar: 100 * intersection >= SIMILAR * union."""
    both = F.size(F.array_intersect(x, y)).cast("long")
    return (100 + SIMILAR) * both >= SIMILAR * (F.size(x) + F.size(y)).cast("long")


def table_members(classes: DataFrame) -> DataFrame:
    """(key, id, x, y) for every table key that more than one class can have; x and y are its bands."""
    halves = classes.select("id", F.posexplode("halves").alias("band", "half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    sides = (
        halves.join(shared, "half")
        .groupBy("id")
        .agg(
            F.collect_list(F.when(F.col("band") < BANDS, F.struct("half", "band"))).alias("first"),
            F.collect_list(F.when(F.col("band") >= BANDS, F.struct("half", "band"))).alias("second"),
        )
    )
    pairs = sides.select("id", F.explode("first").alias("x"), "second").select("id", "x", F.explode("second").alias("y"))
    return pairs.select(
        F.xxhash64("x.half", "y.half").alias("key"), "id", F.col("x.band").alias("x"), F.col("y.band").alias("y")
    )


def _alike(a: str, b: str) -> F.Column:
    """Sizes and minhashes of two classes allow the similarity."""
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= SIMILAR * F.greatest(f"{a}.n", f"{b}.n")
    equal = F.size(F.filter(F.zip_with(f"{a}.sig", f"{b}.sig", lambda x, y: x == y), lambda e: e))
    return sizes & (equal >= LEAST_EQUAL)


def _room(a: str, b: str) -> F.Column:
    """The counts of two sets by block allow the similarity; true where a set has no counts."""
    least = F.zip_with(f"{a}.blocks", f"{b}.blocks", lambda x, y: F.least(x, y).cast("long"))
    most = F.aggregate(least, F.lit(0).cast("long"), lambda total, x: total + x)
    return F.coalesce((100 + SIMILAR) * most >= SIMILAR * (F.col(f"{a}.n") + F.col(f"{b}.n")), F.lit(True))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    return land(both.where(_confirmed("x", "y")).select("a", "b"), "similar")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), content(text_column).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    rows = land(
        texts.mapInArrow(_signatures, f"id {kind}, n long, digest binary, halves array<long>, sig array<smallint>"), "signatures"
    )
    own = rows.where("id IS NOT NULL AND digest IS NOT NULL")
    first = land(own.groupBy("digest").agg(F.min("id").alias("first")), "classes")
    classes = land(
        own.join(first, "digest")
        .where("id = first")
        .dropDuplicates(["id"])  # repeated rows
        .select("id", "n", "halves", "sig"),
        "representatives",
    )
    all_members = land(table_members(classes), "members")
    leaders = all_members.groupBy("key").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("c")).where("c > 1")
    members = land(all_members.join(leaders.select("key", "lead"), "key"), "buckets")
    release(all_members)
    classes = classes.drop("halves")

    wanted = members.select("id").distinct()
    sets = land(
        texts.join(wanted, "id")
        .dropDuplicates(["id"])
        .select("id", "text")
        .mapInArrow(_sets, f"id {kind}, shingles array<long>, blocks array<tinyint>"),
        "sets",
    )
    stars = members.where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    stars = (
        stars.join(classes.alias("s"), F.col("a") == F.col("s.id"))
        .join(classes.alias("t"), F.col("b") == F.col("t.id"))
        .where(_alike("s", "t"))
        .select("a", "b")
    )
    links = _links(stars, sets)
    found = land(components(links), "components")
    release(links)
    still = None
    for turn in range(TURNS):
        if still is None:
            still = _open_rows(members, found)
            if still.isEmpty():
                break
        if turn < TURNS - 1:
            links = _links(_against_one(still, classes, turn), sets)
        else:
            told = land(still.join(classes, "id").join(sets.select("id", "blocks"), "id"), "open")
            links = _links(_between(told), sets)
            release(told)
        if links.isEmpty():  # nothing is linked anew: the open rows stay for the next turn
            release(links)
            continue
        release(still)
        last, found, still = found, land(linked(found, links), "components"), None
        release(last, links)
    if still is not None:
        release(still)
    release(members, sets)

    by_class = first.join(found, F.col("first") == F.col("id"), "left").select(
        "digest", F.coalesce("component", "first").alias("component")
    )
    return rows.join(by_class, "digest", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )


def _open_rows(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id, component, main) of buckets that show more than one component; main is the largest."""
    named = members.join(found, "id", "left").select(
        "key", "id", "x", "y", F.coalesce("component", "id").alias("component")
    )
    parts = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("key").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("n")
    )
    return land(named.join(mixed.where("n > 1").drop("n"), "key"), "open")


def _against_one(rows: DataFrame, classes: DataFrame, turn: int) -> DataFrame:
    """Pairs of one member of the main component, another one each turn, and each row outside it."""
    order = F.xxhash64("id", F.lit(turn))
    one = rows.where("component = main").groupBy("key").agg(F.max_by("id", order).alias("a"))
    pairs = rows.where("component != main").join(one, "key").select("a", F.col("id").alias("b")).distinct()
    return (
        pairs.join(classes.alias("s"), F.col("a") == F.col("s.id"))
        .join(classes.alias("t"), F.col("b") == F.col("t.id"))
        .where(_alike("s", "t"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _between(rows: DataFrame) -> DataFrame:
    """Pairs of one bucket of ``rows`` (with sizes, minhashes and counts by block) that are in different components, each once.

    One end is always outside the main component, so a bucket that is one component, however large,
    gives none. Of the tables in which a pair meets only the one with the smallest half keys counts.
    """
    s, t = rows.where("component != main").alias("s"), rows.alias("t")
    possible = _alike("s", "t") & _first_meeting("s", "t") & _room("s", "t")
    # a pair of two outer rows is met from the larger id only
    order = (F.col("t.component") == F.col("t.main")) | (F.col("s.id") > F.col("t.id"))
    met = (F.col("s.key") == F.col("t.key")) & (F.col("s.component") != F.col("t.component")) & order
    return s.join(t, met & possible).select(
        F.col("s.id").alias("a"), F.col("t.id").alias("b")
    )


def _first_meeting(s: str, t: str) -> F.Column:
    """Is this table that of the first equal half keys of both collections?"""

    def first(low: int, band: str) -> F.Column:
        equal = F.transform(
            F.sequence(F.lit(low), F.lit(low + BANDS - 1)),
            lambda i: (F.col(f"{s}.sig")[2 * i] == F.col(f"{t}.sig")[2 * i])
            & (F.col(f"{s}.sig")[2 * i + 1] == F.col(f"{t}.sig")[2 * i + 1]),
        )
        return F.array_position(equal, True) - 1 + low == F.col(f"{s}.{band}")

    return first(0, "x") & first(BANDS, "y")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns; rows without an id stay."""
    stays = near_groups(docs).where("kept AND id IS NOT NULL").select(F.col("id").alias("_stays")).distinct()
    named = docs.join(stays, docs["doc_id"] == stays["_stays"], "left_semi")
    return named.unionByName(docs.where("doc_id IS NULL"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


QUERIES = {"op8_minhash_near_dedup": op8_minhash_near_dedup}
ORACLE: dict[str, str] = {}
