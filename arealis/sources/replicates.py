"""Replicate files (CSV, plain or gzip) in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions import ids
from arealis.functions.numbers import REPLICATES
from arealis.operators.moe_replicate import select_replicates
from arealis.sources import lines

# The columns of a replicate file, in order.
TEXT_COLUMNS = ("TBLID", "GEOID", "NAME", "ORDER", "TITLE")
_TEXT, _NUMBER = T.StringType(), T.DoubleType()
FILE_SCHEMA = T.StructType(
    [T.StructField(c, _TEXT) for c in TEXT_COLUMNS]
    + [
        T.StructField("estimate", _NUMBER),
        T.StructField("moe", _NUMBER),
        T.StructField("CME", _TEXT),
        T.StructField("SE", _NUMBER),
    ]
    + [T.StructField(f"Var_Rep{i}", _NUMBER) for i in range(1, REPLICATES + 1)]
)
PARTITIONS = ("year", "level", "table", "state")


def _read(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    # a file with other columns is an error
    return lines.parsed(spark, paths, schema, header=True, enforceSchema=False, encoding="ISO-8859-1")


def to_long(raw: DataFrame, *keep: str) -> DataFrame:
    """File rows -> ``(geoid, variable, est, moe, se, reps)``; rows without an id go."""
    order = ids.pad_left("ORDER", 3)
    return raw.where(F.col("GEOID").isNotNull()).select(
        *keep,
        F.col("GEOID").alias("geoid"),
        F.concat_ws("_", "TBLID", order).alias("variable"),
        F.col("estimate").alias("est"),
        "moe",
        F.col("SE").alias("se"),
        F.array(*[F.col(f"Var_Rep{i}") for i in range(1, REPLICATES + 1)]).alias("reps"),
    )


def read_replicates(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] = (),
    geos: Sequence[str] = (),
) -> DataFrame:
    """One scan over all files; the chosen variables and areas of any of them."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return select_replicates(to_long(lines.fitting(_read(spark, FILE_SCHEMA, paths))), columns, geos)


def rejected_replicates(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows whose numbers do not read or that have other cells: ``(path, line, read)``."""
    return lines.rejected(_read(spark, FILE_SCHEMA, [paths] if isinstance(paths, str) else paths))


def read_replicate_tables(
    spark: SparkSession,
    root: str,
    tables: Sequence[str],
    year: int | str,
    level: str,
    state: str | None = None,
    columns: Sequence[str] = (),
    geos: Sequence[str] = (),
) -> DataFrame:
    """Files landed as ``root/year=…/level=…/table=…/state=…``: only the asked directories are read.

    ``level`` is a name or a code; ``state`` matters for tracts and block groups only.
    """
    schema = T.StructType(FILE_SCHEMA.fields + [T.StructField(c, _TEXT) for c in PARTITIONS])
    code = ids.level_code(level)
    raw = lines.fitting(_read(spark, schema, [root])).where(
        (F.col("year") == str(year)) & (F.col("level") == code) & F.col("table").isin(*tables)
    )
    if state is not None and code in ("140", "150"):
        raw = raw.where(F.col("state") == state)
    return select_replicates(to_long(raw), columns, geos)


def write_replicates(df: DataFrame, path: str) -> None:
    """Long rows as replicate files, the inverse of :func:`read_replicates`."""
    parts = F.split("variable", "_")
    reps = [F.get("reps", F.lit(i)).alias(f"Var_Rep{i + 1}") for i in range(REPLICATES)]
    table = F.get(parts, F.lit(0)).alias("table")
    extra = [table if c == "table" else F.col(c) for c in PARTITIONS if c == "table" or c in df.columns]
    flat = df.select(
        F.get(parts, F.lit(0)).alias("TBLID"),
        F.col("geoid").alias("GEOID"),
        F.lit("area").alias("NAME"),
        F.regexp_replace(F.get(parts, F.lit(1)), "^0+(?=.)", "").alias("ORDER"),
        F.lit("title").alias("TITLE"),
        F.col("est").alias("estimate"),
        "moe",
        F.lit("").alias("CME"),
        F.col("se").alias("SE"),
        *reps,
        *extra,
    )
    writer = flat.write.option("header", True).option("encoding", "ISO-8859-1")
    if len(extra) > 1:  # rows of several years, levels or states
        writer = writer.partitionBy(*(c for c in PARTITIONS if c in flat.columns))
    writer.option("compression", "gzip").csv(path)
