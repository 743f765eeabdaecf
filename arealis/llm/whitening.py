"""Whitening of embedding vectors from a covariance weighted by multiplicity.

Entries become whole numbers, and rows with identical vectors are grouped; a group counts as often as it
has rows (or once, as the caller likes). Every task centres its different vectors and adds up their
weighted products as one matrix product; the partial matrices are summed by Spark, a matrix row at a
time. The driver sees one matrix whose sides are the dimension and takes its eigenvectors. Each
different vector is whitened once and joined back to its rows. Vectors that hold more than
1 / ``HOT_SHARE`` of the rows (so there are fewer than ``HOT_SHARE`` of them) are broadcast; the others
are joined by name, none of which can then crowd a task.

Defined results: vectors that are null, or hold a null or an entry that isn't finite, are left out, and so
are empty ones and those whose length isn't the table's commonest (of equally common ones the largest).
Entries are cut at 2^52 after scaling. Repeated rows and null ids come back each. Of equal eigenvalues
any basis is right; one is taken for all rows. A component without spread (all vectors equal, fewer
vectors than components) has null whitened values and is left out of the identity error. A deviation
beyond the range of a long is null. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import land

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Vectors with more than this part of all rows are hot.
HOT_SHARE = 1000
_LARGEST = float(2**52)
_SAFE = float(2**62)


def _whole(vector: Column) -> Column:
    def entry(c: Column) -> Column:
        scaled = F.greatest(F.least(SCALE * c.cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST))
        return F.floor(scaled).cast("long") + SHIFT

    return F.transform(vector, entry)


def _usable(vector: Column) -> Column:
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(F.forall(vector, finite), F.lit(False))


def named_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, x and a name that only equal x share, of the rows that take part."""
    vector = F.col(f"`{vector_column}`")
    rows = df.select(F.col(f"`{id_column}`").alias("id"), vector.alias("v")).where(_usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    first = common.orderBy(F.desc("rows"), F.desc("length")).first()
    rows = rows.where(F.size("v") == (first["length"] if first else 0)).select("id", _whole(F.col("v")).alias("x"))
    return rows.withColumn("name", F.unhex(F.sha2(F.array_join(F.transform("x", lambda c: c.cast("string")), ","), 256)))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def weighted_sums(distinct: DataFrame, column: str = "x") -> tuple[int, list[int]]:
    """Sum of the weights and exact weighted sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weights = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _matrix(batch, column), batch.column(batch.schema.get_field_index("weight")).to_numpy()
            if float(np.abs(x).max()) * float(w.sum()) < _SAFE:
                some = (x * w[:, None]).sum(0).astype(object)
            else:
                some = (x.astype(object) * w.astype(object)[:, None]).sum(0)
            total = some if total is None else total + some
            weights += int(w.sum())
        if total is not None:
            places = [-1, *range(len(total))]
            values = pa.array([Decimal(int(v)) for v in (weights, *total)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), values], names=["place", "value"])

    parts = distinct.select(column, "weight").mapInArrow(run, "place int, value decimal(38,0)")
    found = {r["place"]: int(r["value"]) for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    return found.pop(-1, 0), [found[i] for i in range(len(found))]


def _mean(distinct: DataFrame, column: str) -> np.ndarray:
    """Weighted mean of float vectors."""
    sums = distinct.select(F.posexplode(column).alias("place", "c"), "weight")
    rows = sums.groupBy("place").agg((F.sum(F.col("c") * F.col("weight")) / F.sum("weight")).alias("mean")).collect()
    return np.array([r["mean"] for r in sorted(rows, key=lambda r: r["place"])])


def covariance(distinct: DataFrame, column: str, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance about ``mean`` with divisor ``n``, counted by weight."""
    size = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch, column) - mean
                weight = batch.column(batch.schema.get_field_index("weight")).to_numpy()
                total += centred.T @ (centred * weight[:, None])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(size), pa.int32()), "c": pa.array(list(total))})

    def added(rows: pa.Table) -> pa.Table:
        c = rows.column("c").combine_chunks().flatten().to_numpy().reshape(len(rows), -1).sum(0)
        return pa.table({"i": rows.column("i").slice(0, 1), "c": pa.array([c])})

    schema = "i int, c array<double>"
    parts = distinct.select(column, "weight").mapInArrow(run, schema)
    rows = parts.groupBy("i").applyInArrow(added, schema).collect()
    return np.array([r["c"] for r in sorted(rows, key=lambda r: r["i"])]).reshape(size, size) / n


@dataclass
class Model:
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    trace: float

    @property
    def spread(self) -> np.ndarray:
        """Which components vary at all, beyond rounding."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(self.trace, 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Null (nan) where a component has no spread."""
        mean = np.array([s / self.n for s in self.sums])
        scale = np.where(self.spread, np.sqrt(np.maximum(self.values, 0.0)), np.nan)
        return (x - mean) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 in whole numbers."""
        rough = np.abs(x.astype(float)) * self.n + np.abs(np.array(self.sums, float))
        if len(x) and float((rough**2).sum(1).max()) < _SAFE:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d < 2**63 else None for d in exact]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Principal components of (x, weight) rows; none of an empty table."""
    n, sums = weighted_sums(distinct)
    if not n:
        return None
    scatter = covariance(distinct, "x", np.array([s / n for s in sums]), n)
    values, vectors = np.linalg.eigh((scatter + scatter.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    largest = np.abs(vectors).argmax(0)  # the largest coordinate is positive
    vectors = vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Model(n, sums, values, vectors, float(np.trace(scatter)))


def whitened_vectors(distinct: DataFrame, model: Model) -> DataFrame:
    """name, weight, copies, deviation and whitened of each different vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "x")
                white = model.whitened(x)
                columns = {
                    **{n: batch.column(batch.schema.get_field_index(n)) for n in ("name", "weight", "copies")},
                    "deviation": pa.array(model.deviations(x), pa.int64()),
                    "whitened": pa.array([[None if np.isnan(c) else c for c in row] for row in white], pa.list_(pa.float64())),
                }
                yield pa.RecordBatch.from_pydict(columns)

    schema = "name binary, weight bigint, copies bigint, deviation bigint, whitened array<double>"
    return distinct.select("name", "weight", "copies", "x").mapInArrow(run, schema)


def identity_error(white: DataFrame, model: Model) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    some = np.flatnonzero(model.spread)
    if not len(some):
        return None
    varying = F.filter("whitened", lambda c: c.isNotNull())
    rows = white.select(varying.alias("whitened"), "weight")
    found = covariance(rows, "whitened", _mean(rows, "whitened"), model.n)
    return float(np.abs(found - np.eye(len(some))).max())


def whiten(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    by_count: bool = True,
) -> DataFrame:
    """id, copies, deviation, whitened (an array) of every row that takes part, and the fit's n,
    explained (an array) and identity_error. ``by_count`` false fits on different vectors alone."""
    spark = df.sparkSession
    rows = land(named_vectors(df, id_column, vector_column), "vectors")
    copies = F.count(F.lit(1))
    weight = F.col("copies") if by_count else F.lit(1).cast("long")
    distinct = land(rows.groupBy("name", "x").agg(copies.alias("copies")).withColumn("weight", weight), "distinct")
    model = fit(distinct, components)
    kind = T.StructType([rows.schema["id"]])
    for name, ddl in (
        ("copies", "bigint"), ("deviation", "bigint"), ("whitened", "array<double>"),
        ("n", "bigint"), ("explained", "array<double>"), ("identity_error", "double"),
    ):
        kind = kind.add(name, T.DataType.fromDDL(ddl))
    if model is None:
        return spark.createDataFrame([], kind)
    white = land(whitened_vectors(distinct, model), "white")
    error = identity_error(white, model)
    total = white.agg(F.sum("copies")).first()[0]
    is_hot = F.col("copies") * HOT_SHARE > total
    hot = F.broadcast(white.where(is_hot))  # fewer than HOT_SHARE rows
    ids = rows.select("id", "name")
    back = ids.join(hot, "name").unionByName(ids.join(hot, "name", "left_anti").join(white.where(~is_hot), "name"))
    shares = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    return back.select(
        "id", "copies", "deviation", "whitened",
        F.lit(model.n).cast("long").alias("n"),
        F.array(*(F.lit(s).cast("double") for s in shares)).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "one")
    return rows.select("id", "n", "deviation", "identity_error", one).select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).cast("int").alias("component"),
        "n", "deviation", "one.whitened", "one.explained", "identity_error",
    )


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
ORACLE: dict[str, str] = {}
