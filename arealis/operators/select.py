"""Choosing columns and rows, putting tables together, requested versus present."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.numbers import MISSING_CODES, missing_to_null

# --- columns ----------------------------------------------------------------------------


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")


def key_first(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[c for c in df.columns if c != key])


def numeric_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns all of whose values read as numbers: one aggregate over the table."""
    fails = [
        F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), 1)).alias(c)
        for c in cols
    ]
    if not fails:
        return []
    counts = df.agg(*fails).first()
    return [c for c in cols if counts[c] == 0]


# Types a variable dictionary declares.
NUMBER_TYPES, TEXT_TYPES = ("int", "float"), ("string",)


def to_numbers(df: DataFrame, cols: Sequence[str], types: Mapping[str, str | None] | None = None) -> DataFrame:
    """Cast each column to double as a whole, or leave it unchanged.

    ``types`` are those the variable dictionary declares; only columns without one are looked
    through, by one aggregate over the table. A declared number that doesn't read as one is missing.
    """
    types = types or {}
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    open_ = [c for c in text if types.get(c) not in (*NUMBER_TYPES, *TEXT_TYPES)]
    declared = {c for c in text if types.get(c) in NUMBER_TYPES}
    numeric = declared | set(numeric_columns(df, open_)) | (set(cols) - set(text))
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols if c in numeric})


def replace_missing(
    df: DataFrame, cols: Sequence[str], codes: Iterable[float] = MISSING_CODES
) -> DataFrame:
    """Codes for a missing estimate -> NULL, in the columns that hold numbers."""
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    return df.withColumns({c: missing_to_null(F.col(c), codes) for c in numeric})


# --- rows -----------------------------------------------------------------------------------


def any_of(column: str, values: str | Sequence[str]) -> Column | None:
    """Filter on ids given as a list or ``'a,b'``; ``'*'`` or nothing is no filter."""
    if isinstance(values, str):
        values = [v.strip() for v in values.split(",")]
    values = list(values)
    if not values or values == ["*"] or values == [""]:
        return None
    return F.col(column).isin(*values)


def where_all(df: DataFrame, predicates: Mapping[str, str | Sequence[str]]) -> DataFrame:
    require_columns(df, predicates)
    conditions = [any_of(k, v) for k, v in predicates.items()]
    return reduce(lambda d, c: d.where(c), [c for c in conditions if c is not None], df)


# --- joins and unions -----------------------------------------------------------------------


def join_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Column chunks of one wide table, joined on all columns they share."""

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in left.columns if c in right.columns]
        if not shared:
            raise ValueError("the chunks share no column")
        return left.join(right, shared, "inner")

    return reduce(step, chunks)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Equi-join on keys with different names; both keys are kept.

    Names that occur on both sides (in any case) get the suffixes. Keys with the same
    name on both sides appear once.
    """
    same = {a for a, b in zip(left_on, right_on) if a == b}
    lower_l = {c.lower() for c in left.columns} - {c.lower() for c in same}
    lower_r = {c.lower() for c in right.columns} - {c.lower() for c in same}
    both = lower_l & lower_r
    names_l = {c: c + suffixes[0] if c.lower() in both else c for c in left.columns}
    names_r = {c: c + suffixes[1] if c.lower() in both else c for c in right.columns}
    left = left.withColumnsRenamed(names_l)
    tagged = right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns})
    on = [
        left[names_l[a]] == tagged[f"_r_{b}"] for a, b in zip(left_on, right_on)
    ]
    joined = left.join(tagged, reduce(lambda a, b: a & b, on), how)
    kept = [F.col(f"_r_{c}").alias(n) for c, n in names_r.items() if c not in same]
    return joined.select(*left.columns, *kept)


def attach_values(areas: DataFrame, values: DataFrame, key: str = "GEOID") -> DataFrame:
    """Areas with their variables; an area without values keeps NULLs.

    The values, usually far more than the areas asked for, are first cut down to those
    areas: where the areas are few this is a filter in the scan's stage, and only what is
    left of the values is shuffled.
    """
    wanted = values.join(areas.select(key), key, "left_semi")
    return areas.join(wanted, key, "left")


# --- requested versus present ----------------------------------------------------------------


def requested(spark: SparkSession, ids: Sequence[str], key: str = "geoid") -> DataFrame:
    """A given list as a table ``(key, position)``."""
    schema = T.StructType(
        [T.StructField(key, T.StringType()), T.StructField("position", T.LongType())]
    )
    return spark.createDataFrame(list(zip(ids, range(len(ids)))), schema)


def absent(wanted: DataFrame, found: DataFrame, key: str = "geoid") -> DataFrame:
    return wanted.join(found.select(key), key, "left_anti")


def present(wanted: DataFrame, found: DataFrame, key: str = "geoid") -> DataFrame:
    return wanted.join(found.select(key), key, "left_semi")


def as_requested(wanted: DataFrame, data: DataFrame, key: str = "geoid") -> DataFrame:
    """One row per requested id with its position; ids without data keep NULLs.

    ``orderBy('position')`` gives the order of the request.
    """
    return wanted.select(key, "position").join(data, key, "left")


# --- batches for an outside fetcher ------------------------------------------------------------


def column_batches(cols: Sequence[str], most: int = 49) -> list[list[str]]:
    """Column names in near-equal chunks of at most ``most``, the larger chunks first."""
    n, k = len(cols), max(1, math.ceil(len(cols) / most))
    sizes = [n // k + (i < n % k) for i in range(k)]
    starts = [sum(sizes[:i]) for i in range(k)]
    return [list(cols[s : s + z]) for s, z in zip(starts, sizes)]


def id_batches(
    df: DataFrame, by: Sequence[str], key: str, bucket: Column, most: int = 500
) -> DataFrame:
    """Number the ids of each group into near-equal chunks, the larger chunks first.

    The order within a group is by ``bucket``, then by ``key``; ``bucket`` has to grow
    with ``key`` (a prefix of it) and cuts a group into pieces that are ordered one by
    one, so that a group of any size is never sorted in one task: only the counts of the
    buckets are accumulated over the group.
    """
    from pyspark.sql import Window

    rows = df.select(*by, key, bucket.alias("_bucket"))
    counts = rows.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    over = Window.partitionBy(*by).orderBy("_bucket")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    starts = counts.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(whole).alias("_total"),
    )
    local = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(key)) - 1
    placed = rows.withColumn("_local", local).join(starts, [*by, "_bucket"])
    position = F.col("_start") + F.col("_local")
    chunks = F.ceil(F.col("_total") / F.lit(float(most)))
    small = F.floor(F.col("_total") / chunks.cast("double"))
    larger = F.col("_total") - small * chunks
    in_larger = position < larger * (small + 1)
    chunk = F.when(in_larger, F.floor(position / (small + 1).cast("double"))).otherwise(
        larger + F.floor((position - larger * (small + 1)) / small.cast("double"))
    )
    return placed.select(*by, key, position.alias("position"), chunk.cast("long").alias("batch"))
