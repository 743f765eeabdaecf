"""One large JSON text read by many tasks: it is cut where records start, not held whole.

Spark's text source splits a file at any separator. A record of a layer starts with the same characters
each time, and these cannot occur within a string, where quotes are escaped; a response has a row per
line. What describes the file (its first piece, or line) meets the pieces by path; it is copied to
``COPIES`` parts of them, so that one large file is not one key. Works on whatever store Spark reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.session import land
from arealis.sources.features import parsed_layers, shaped
from arealis.sources.responses import columns_of_headers, rows_to_cells, to_columns

FEATURE = '{"attributes"'
COPIES = 64


def cut(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``(path, value)`` of all pieces between separators; a task reads a range of bytes of a file."""
    pieces = spark.read.option("lineSep", separator).text(path)
    return pieces.select(F.col("_metadata.file_path").alias("path"), "value")


def _described(pieces: DataFrame, heads: DataFrame, *columns: str) -> DataFrame:
    """``pieces`` with the columns of their file's head."""
    part = F.pmod(F.xxhash64("value"), F.lit(COPIES)).alias("_part")
    copies = heads.select("path", *columns, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1).cast("long"))).alias("_part"))
    return pieces.select("*", part).join(copies, ["path", "_part"]).drop("_part")


# --- layers ---------------------------------------------------------------------------------


def read_features(
    spark: SparkSession,
    path: str,
    attributes: Mapping[str, str],
    z: bool = False,
    m: bool = False,
    start: str = FEATURE,
) -> DataFrame:
    """The rows of :func:`features.read_features` for files of any size, one layer each.

    ``start`` is how every feature begins, as the server writes it, up to its first name. The kind and
    the reference system must stand before the features, else the read ends with an error. What stands
    before them is written once, so that its size is known to the join.
    """
    pieces, is_head = cut(spark, path, start), _is_head(start)
    heads = parsed_layers(pieces.where(is_head).select("path", F.concat("value", F.lit("]}")).alias("value")), attributes)
    heads = land(heads.select("path", F.col("j.geometryType").alias("type"), "srid"), "heads")
    told = _described(pieces.where(~is_head), heads, "type", "srid")
    kind = F.coalesce("type", F.raise_error(F.concat(F.lit("not described before its features: "), "path")).cast("string"))
    # behind a feature the piece goes on to the next one, or to the end of the list: the parser stops before
    texts = told.select("path", kind.alias("type"), "srid", F.concat(F.lit(start), "value").alias("value"))
    return shaped(texts, attributes, z, m)


def _is_head(start: str) -> Column:
    """The piece before the first record; the others go on behind a name, with a colon."""
    if not start.startswith("{") or not start.endswith('"'):
        raise ValueError('start must be like {"name"')
    return F.ltrim("value").startswith("{")


def broken_features(spark: SparkSession, path: str, start: str = FEATURE) -> DataFrame:
    """Pieces ``(path, value)`` that are no feature: the read leaves them out."""
    pieces = cut(spark, path, start).where(~_is_head(start))
    text = F.concat(F.lit(start), "value")
    return pieces.where(F.from_json(text, "attributes map<string, string>").getField("attributes").isNull())


# --- responses -------------------------------------------------------------------------------


def response_lines(spark: SparkSession, path: str) -> DataFrame:
    """Data rows ``(path, header, row)`` of responses with a row per line, however long."""
    lines = cut(spark, path, "\n")
    trimmed = F.trim("value")
    whole = F.endswith(trimmed, F.lit("]]"))
    first = F.startswith(trimmed, F.lit("[["))
    # the first line holds the header, and all rows if the file has one line
    table = F.from_json(F.when(whole, trimmed).otherwise(F.concat(F.regexp_replace(trimmed, ",$", ""), F.lit("]"))), "array<array<string>>")
    heads = land(lines.where(first).select("path", table.alias("t")), "heads")
    rows = lines.where(~first & (trimmed != "") & (trimmed != "]")).select("path", F.from_json(trimmed, "array<string>").alias("row"), "value")
    more = heads.select("path", F.get("t", F.lit(0)).alias("header"), F.explode(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))).alias("row"))
    told = _described(rows, heads.select("path", F.get("t", F.lit(0)).alias("header")), "header")
    return told.select("path", "header", "row").unionByName(more.select("path", "header", "row"))


def read_responses(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of :func:`responses.read_responses` for files of any size with a row per line."""
    lines = response_lines(spark, path).where("row IS NOT NULL")
    names = columns or columns_of_headers(lines.select(F.col("header").alias("h"), "path"))
    return to_columns(rows_to_cells(lines, "path"), names)
