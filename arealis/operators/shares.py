"""Derived values over areas: shares, change between vintages, dissimilarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.numbers import divide
from arealis.operators.moe_replicate import over_areas
from arealis.operators.select import merge


def with_share(df: DataFrame, name: str, group: str, total: str) -> DataFrame:
    return df.withColumn(name, divide(F.col(group), F.col(total)))


def change(
    later: DataFrame, earlier: DataFrame, value: str, key: str, suffixes: tuple[str, str]
) -> DataFrame:
    """Two vintages side by side with the relative change of one value."""
    both = merge(later, earlier, [key], [key], suffixes=suffixes)
    new, old = F.col(value + suffixes[0]), F.col(value + suffixes[1])
    return both.withColumn("pct_change", divide(new - old, old))


def dissimilarity(df: DataFrame, group: str, total: str) -> DataFrame:
    """Half the summed difference of the two groups' spread over the areas, one row."""
    part, rest = F.col(group).cast("double"), F.col(total) - F.col(group)

    def whole(c: Column) -> Column:
        return df.agg(F.sum(c).alias("s")).scalar()

    gap = F.abs(divide(part, whole(part)) - divide(rest, whole(rest)))
    return df.agg((F.lit(0.5) * F.sum(gap)).alias("dissimilarity"))


def dissimilarity_with_moe(df: DataFrame, group: str, rest: str, by: dict[str, Column] | None = None) -> DataFrame:
    """:func:`dissimilarity` of two variables of replicate rows, with its margin; ``by`` as in
    :func:`arealis.operators.moe_replicate.over_areas`."""
    return over_areas(
        df,
        [group, rest],
        lambda v, t: F.abs(divide(v[group], t["group"]) - divide(v[rest], t["rest"])),
        {"group": lambda v: v[group], "rest": lambda v: v[rest]},
        lambda total: F.lit(0.5) * total,
        by,
    )
