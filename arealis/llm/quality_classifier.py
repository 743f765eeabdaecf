"""Quality scores by ridge regression on random Fourier features, calibrated by isotonic regression.

Every text becomes a vector of statistics; random Fourier features of the standardised vector
approximate a Gaussian kernel. Each task sums its part of the normal equations, Spark adds the
parts, and the driver solves one system of ``FEATURES`` unknowns. Isotonic regression on a part of
the labelled rows kept apart turns raw scores into shares of label 1.

The fit uses at most about ``MOST_LABELS`` labelled rows, chosen by a hash of the id; scoring covers all.

Defined results: a null text counts as empty and is scored like any other; rows with a null label or
id teach nothing, a null id counts as held out; without labelled rows every score is 0.5; a label that
occurs twice counts twice; an empty table gives no rows. Labels, lang, source and doc_id are never
inputs of a score.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import content, documents, land
from arealis.llm.language import held_out

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
MOST_LABELS = 200_000
BINS = 500
ACCEPT = 0.3
#: Rows whose texts and results a worker holds at once, beside the batch it is handed.
PART = 256

_BYTES = np.arange(256)


def _class(characters: bytes) -> np.ndarray:
    return np.isin(_BYTES, np.frombuffer(characters, np.uint8)).astype(float)


#: Byte classes whose shares are statistics.
CLASSES = np.stack(
    [
        _class(b"#*$%&|<>"),
        _class(b"!?"),
        _class(b".,;:'\"-()"),
        _class(b"0123456789"),
        _class(bytes(range(65, 91))),
        _class(bytes(range(97, 123))),
        _class(b" \t\x0b\x0c\r"),
        _class(b"\n"),
        _class(b"@/_=+{}[]\\^~`"),
        (_BYTES >= 0xC0).astype(float),
    ],
    axis=1,
)
STATISTICS = CLASSES.shape[1] + 9


def statistics(text: str) -> np.ndarray:
    """Logarithms and shares; defined (zeros mostly) for an empty text."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.sqrt(counts @ CLASSES / max(1, len(raw)))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(1, len(lines))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return np.append(
        shares,
        [
            np.log1p(len(words)),
            np.log1p(len(raw) / n),
            len(set(words)) / n,
            pairs / max(1, len(words) - 1),
            sum(map(operator.eq, words, words[1:])) / n,
            np.log1p(len(lines)),
            np.log1p(n / n_lines),
            1 - len(set(lines)) / n_lines,
            max(map(len, words), default=0) ** 0.25,
        ],
    )


@dataclass
class Model:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    at: np.ndarray  # raw scores, rising
    share: np.ndarray  # their calibrated scores, rising

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return fourier(rows, self.centre, self.spread) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.full(len(rows), 0.5)
        return np.clip(np.interp(self.raw(rows), self.at, self.share), 0, 1)


def fourier(rows: np.ndarray, centre: np.ndarray, spread: np.ndarray, seed: int = 7) -> np.ndarray:
    """cos(w·x + b) of the standardised rows, with a constant in front."""
    draw = np.random.default_rng(seed)
    w = draw.normal(size=(rows.shape[1], FEATURES - 1)) / WIDTH
    b = draw.uniform(0, 2 * np.pi, FEATURES - 1)
    x = np.clip((rows - centre) / spread, -6, 6)
    return np.hstack([np.ones((len(rows), 1)), np.sqrt(2 / FEATURES) * np.cos(x @ w + b)])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of ``PART`` rows, so that a worker holds few texts and results beside the batch itself."""
    for batch in batches:
        for start in range(0, max(1, len(batch)), PART):
            yield batch.slice(start, PART)


def _rows(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), -1)


def text_statistics(docs: DataFrame, carry: list[Column], text_column: str = "text") -> DataFrame:
    """The ``carry`` columns and ``stats``, the vector of each whole text."""
    rows = docs.select(*carry, content(text_column).alias("stats"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            *kept, text = batch.columns
            stats = pa.array([statistics(t) for t in text.to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*kept, stats], names=batch.schema.names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("stats", T.ArrayType(T.DoubleType()))]))


def _equations(rows: DataFrame, centre: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations, summed in each task and then by cell (FEATURES squared, halved, is the bound)."""
    upper = np.triu_indices(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, right = np.zeros((FEATURES, FEATURES)), np.zeros(FEATURES)
        for batch in batches:
            z, y = fourier(_rows(batch.column(0)), centre, spread), batch.column(1).to_numpy().astype(float)
            square += z.T @ z
            right += z.T @ y
        values = np.append(square[upper], right)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["cell", "v"])

    sums = rows.select("stats", "label").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    cells = sums.toPandas().set_index("cell")["v"].reindex(range(len(upper[0]) + FEATURES), fill_value=0.0).to_numpy()
    square = np.zeros((FEATURES, FEATURES))
    square[upper] = cells[:-FEATURES]
    return square + np.triu(square, 1).T, cells[-FEATURES:]


def isotonic(x: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; centres of the blocks and their shares."""
    blocks: list[list[float]] = []
    for at, weight, good in zip(x, n, hits, strict=True):
        blocks.append([at * weight, weight, good])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    table = np.array(blocks).reshape(-1, 3)
    return table[:, 0] / table[:, 1], table[:, 2] / table[:, 1]


def fit(labelled: DataFrame, key: str = "doc_id", most: int = MOST_LABELS) -> Model:
    """``labelled``: key, stats, label (0 or 1)."""
    rows = labelled.where("label IS NOT NULL")
    total = rows.count()
    place = F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit("fit")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    if total > most:
        rows = rows.where(place < most / total)
    part = F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit("part")), F.lit(4)) == 0
    rows = land(rows.select("stats", F.col("label").cast("int").alias("label"), part.alias("part")), "labelled")
    moments = rows.select(F.posexplode("stats").alias("k", "v")).groupBy("k").agg(F.avg("v"), F.stddev_pop("v"))
    found = np.array(sorted(tuple(r) for r in moments.collect())).reshape(-1, 3)
    nothing = np.zeros(0)
    if not len(found):
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros(FEATURES), nothing, nothing)
    centre, spread = found[:, 1], np.maximum(found[:, 2], 1e-3)
    square, right = _equations(rows.where("not part"), centre, spread)
    n = max(1.0, square[0, 0])
    weights = np.linalg.solve(square + RIDGE * n * np.eye(FEATURES) / FEATURES, right)
    model = Model(centre, spread, weights, nothing, nothing)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_rows(batch.column(0)))
            bins = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins), pa.array(raw), batch.column(1)], names=["bin", "raw", "label"]
            )

    bins = (
        rows.where("part").select("stats", "label")
        .mapInArrow(binned, "bin long, raw double, label int")
        .groupBy("bin")
        .agg(F.avg("raw").alias("raw"), F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
        .orderBy("bin")
        .toPandas()  # at most BINS rows
    )
    if not len(bins):
        return Model(centre, spread, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    model.at, model.share = isotonic(*(bins[c].to_numpy(float) for c in ("raw", "n", "hits")))
    return model


def score_statistics(rows: DataFrame, model: Model) -> DataFrame:
    """``stats`` replaced by score (0 to 1) and predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, stats = batch.columns
            score = model.scores(_rows(stats)) if len(stats) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *added]))


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted 1, all columns, in one pass without a shuffle."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = batch.column(at).to_pylist()
            stats = np.array([statistics(t or "") for t in texts]).reshape(len(texts), STATISTICS)
            yield batch.filter(pa.array(model.scores(stats) >= ACCEPT, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def labelled_statistics(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Statistics of the rows that may be learnt from, with their label."""
    known = labels.select(F.col("doc_id"), F.col(f"`{label}`").alias("label"))
    return stats.where(~held_out(5, 0)).join(known, "doc_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = land(text_statistics(documents(spark, sf_dir), [F.col("doc_id")]), "statistics")
    model = fit(labelled_statistics(stats, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows = stats.select("doc_id", held_out(5, 0).alias("held_out"), "stats")
    return score_statistics(rows, model)


QUERIES = {"op6_quality_classifier": op6_quality_classifier}
ORACLE: dict[str, str] = {}
