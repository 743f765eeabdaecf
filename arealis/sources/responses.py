"""Landed query responses: an array of string arrays, the first of them the header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.sources.catalogue import documents

_TABLE = T.ArrayType(T.ArrayType(T.StringType()))


def _parsed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("t", F.from_json("value", _TABLE))


def response_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per data row: ``(path, position, *keep, cells map<column, value>)``.

    Headers may differ from file to file. Files that do not parse give no rows; see
    :func:`broken`.
    """
    rows = _parsed(docs).where("size(t) > 1").select(
        "path",
        *keep,
        F.get("t", F.lit(0)).alias("header"),
        F.posexplode(F.slice("t", 2, F.size("t") - 1)).alias("position", "row"),
    )
    return rows_to_cells(rows, "path", "position", *keep)


def rows_to_cells(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows with their ``header`` -> ``cells map<column, value>``; cells beyond the header are left out
    (:func:`arealis.sources.rejects.uneven_rows` names such rows)."""
    # maps take each key once; a repeated column keeps its first value
    header = F.array_distinct("header")
    first = F.transform(header, lambda h: F.get("row", F.array_position("header", h).cast("int") - 1))
    return rows.select(*keep, F.map_from_arrays(header, first).alias("cells"))


def to_columns(rows: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    picked = [F.try_element_at("cells", F.lit(c)).alias(c) for c in columns]
    return rows.select(*keep, *picked)


def columns_of(docs: DataFrame) -> list[str]:
    """All columns that any header has, in the order of the headers by file name.

    Distinct headers are few; they are all that is brought to the driver.
    """
    return columns_of_headers(_parsed(docs).where("size(t) > 0").select(F.get("t", F.lit(0)).alias("h"), "path"))


def columns_of_headers(headers: DataFrame) -> list[str]:
    headers = headers.groupBy("h").agg(F.min("path").alias("p"))
    return list(dict.fromkeys(c for r in headers.orderBy("p", "h").collect() for c in r["h"]))


def read_responses(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, per_line: bool = False
) -> DataFrame:
    """Rows of all files with the named columns, else with all that occur; a column that a file
    lacks is missing in its rows."""
    docs = documents(spark, path, per_line)
    return to_columns(response_rows(docs), columns or columns_of(docs))


def broken(docs: DataFrame) -> DataFrame:
    """Files that are no response table, for a quarantine table."""
    return _parsed(docs).where(F.col("t").isNull() | (F.size("t") == 0)).select("path", "value")
