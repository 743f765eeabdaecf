"""CSV files whose rows may not fit: such rows are named, never cut or read as missing.

A row with more cells than the table has columns, or with a text where a number belongs, is rejected.
In a table of texts a shorter row is filled up, as spreadsheets leave empty cells at the end away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_line_that_does_not_fit"


def texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def cells_of(line: Column | str, sep: str) -> Column:
    """Number of cells of a line; separators within quotes are none."""
    plain = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1


def widest(spark: SparkSession, path: str, sep: str, encoding: str = "ISO-8859-1") -> int:
    """Cells of the longest line of a file."""
    lines = spark.read.option("encoding", encoding).text(path)
    return lines.agg(F.max(cells_of("value", sep)).alias("n")).first()["n"] or 0


def parsed(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = ",", **options: str | bool
) -> DataFrame:
    """All rows of the files, with the line of those that do not fit."""
    full = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    reader = spark.read.schema(full).options(
        sep=sep, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, columnPruning=False, **options
    )
    rows = reader.csv([paths] if isinstance(paths, str) else list(paths))
    if all(isinstance(f.dataType, T.StringType) for f in schema.fields):
        # nothing is wrong with a short row of texts
        short = cells_of(_BAD, sep) <= len(schema)
        rows = rows.withColumn(_BAD, F.when(short, F.lit(None)).otherwise(F.col(_BAD)))
    return rows


def _asked(rows: DataFrame) -> Column:
    """True; all cells are read for it, whichever are asked for: else a row would fit one query and not another."""
    return F.xxhash64(*(c for c in rows.columns if c != _BAD)) % 1 == 0


def fitting(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(_BAD).isNull() & _asked(rows)).drop(_BAD)


def rejected(rows: DataFrame) -> DataFrame:
    """``(path, line, read)`` of rows that do not fit; ``read`` is what could be read of them."""
    names = [c for c in rows.columns if c != _BAD]
    return rows.where(F.col(_BAD).isNotNull() & _asked(rows)).select(
        F.col("_metadata.file_path").alias("path"), F.col(_BAD).alias("line"), F.to_json(F.struct(*names)).alias("read")
    )
