"""The variable dictionary: search, expansion of patterns, explanations, table lists.

A dictionary has one row per variable: ``name, label, concept, group, required, …``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.ids import ends_in_digit
from arealis.functions.text import matches

Engine = str | Callable[[str, str], bool]


def search(df: DataFrame, pattern: str, by: str = "name", engine: Engine = "re") -> DataFrame:
    """Rows of a dictionary or table list whose field matches; a field the table lacks
    means the name."""
    field = by if by in df.columns else df.columns[0]
    return df.where(matches(field, pattern, engine))


def expand(dictionary: DataFrame, patterns: str | Sequence[str], *more: str) -> DataFrame:
    """Distinct names that match any of the patterns, in order of name; with ``more`` columns."""
    patterns = [patterns] if isinstance(patterns, str) else list(patterns)
    if not patterns:
        return dictionary.select("name", *more).limit(0)
    hit = reduce(lambda a, b: a | b, [matches("name", p) for p in patterns])
    return dictionary.where(hit).select("name", *more).distinct().orderBy("name")


def explain_variables(dictionary: DataFrame, names: str | Sequence[str]) -> DataFrame:
    """Label and concept of the named variables."""
    names = [names] if isinstance(names, str) else list(names)
    return dictionary.where(F.col("name").isin(*names)).select("name", "label", "concept")


def required_predicates(dictionary: DataFrame) -> DataFrame:
    return dictionary.where(F.col("required").isNotNull())


def _columns_by_group(dictionary: DataFrame) -> DataFrame:
    return dictionary.where(F.col("group").isNotNull()).select(
        F.col("group").alias("table"), F.col("name").alias("column"), "concept"
    )


def _columns_by_stem(dictionary: DataFrame) -> DataFrame:
    parts = F.split("name", "_")
    return dictionary.where(F.size(parts) == 2).select(
        F.get(parts, F.lit(0)).alias("table"), F.col("name").alias("column"), "concept"
    )


def _described(columns: DataFrame) -> DataFrame:
    """One row per table with the number of columns; ``single`` tells that all of them
    share one description (no description counts as one of its own)."""
    some = F.count("concept")
    return columns.groupBy("table").agg(
        F.min("concept").alias("description"),
        F.count("*").alias("n_columns"),
        F.when(some == 0, F.lit(True))
        .otherwise((some == F.count("*")) & (F.min("concept") == F.max("concept")))
        .alias("single"),
    )


def table_list(dictionary: DataFrame, form: str, crosstabs: bool = False) -> DataFrame:
    """Main tables (last character a digit) or crosstabs: ``(table, description, n_columns)``.

    ``form='decennial'`` goes by the group of a variable and drops groups with several
    descriptions; ``form='survey'`` goes by the stem before the only ``_`` of a name and
    raises for a stem with several descriptions.
    """
    if form == "decennial":
        stems = _described(_columns_by_group(dictionary)).where("single")
    elif form == "survey":
        # a filter, which no later choice of columns can drop
        failed = F.raise_error(F.concat(F.lit("more than one description in table "), F.col("table")))
        described = _described(_columns_by_stem(dictionary)).where(F.col("table") != "GEO")
        stems = described.where(F.when(F.col("single"), F.lit(True)).otherwise(failed))
    else:
        raise ValueError("form must be 'decennial' or 'survey'")
    main = ends_in_digit("table")
    return stems.where(~main if crosstabs else main).select("table", "description", "n_columns")


def table_columns(dictionary: DataFrame, form: str, crosstabs: bool = False) -> DataFrame:
    """The columns of those tables, one row each: ``(table, column)``.

    Rows, not a list per table, so that no table has to fit into one task.
    """
    split = _columns_by_group if form == "decennial" else _columns_by_stem
    tables = table_list(dictionary, form, crosstabs).select("table")
    return split(dictionary).join(tables, "table", "left_semi").select("table", "column")
