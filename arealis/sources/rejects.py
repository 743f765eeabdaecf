"""Documents that a reader cannot use: error answers, broken or empty files.

Every JSON reader drops them from its rows; this names them, so that a load can count or keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a usable document of each kind has, as a schema and the expression that must not be null.
REQUIRED = {
    "catalogue": ("dataset array<string>", "j.dataset"),
    "variables": ("variables map<string, string>", "j.variables"),
    "geographies": ("map<string, array<string>>", "get(map_values(j), 0)"),
    "tags": ("map<string, array<string>>", "get(map_values(j), 0)"),
    "examples": ("array<string>", "j"),
    "services": ("services array<string>", "j.services"),
    "layers": ("layers array<string>", "j.layers"),
    "features": ("geometryType string, features array<string>", "if(j.geometryType IS NULL, NULL, j.features)"),
    "responses": ("array<array<string>>", "get(j, 0)"),
}


def split(docs: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """``(path, value)`` documents -> those the reader of this kind takes, and the rejected ones."""
    if kind not in REQUIRED:
        raise ValueError(f"kind must be one of {', '.join(REQUIRED)}")
    schema, needed = REQUIRED[kind]
    good = F.expr(f"{needed} IS NOT NULL")
    parsed = docs.withColumn("j", F.from_json("value", schema))
    return parsed.where(good).drop("j"), parsed.where(~F.coalesce(good, F.lit(False))).drop("j")


def uneven_rows(docs: DataFrame) -> DataFrame:
    """Rows ``(path, position, header, row)`` of responses with more or fewer cells than their header."""
    tables = docs.withColumn("t", F.from_json("value", "array<array<string>>")).where("size(t) > 1")
    rows = tables.select("path", F.get("t", F.lit(0)).alias("header"), F.posexplode(F.slice("t", 2, F.size("t") - 1)).alias("position", "row"))
    return rows.where(F.size("row") != F.size("header")).select("path", "position", "header", "row")


def rejected(docs: DataFrame, kind: str) -> DataFrame:
    return split(docs, kind)[1]
