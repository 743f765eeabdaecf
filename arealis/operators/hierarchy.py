"""Walking the area hierarchy: an id carries the ids of its parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions import ids

# Fixed value: state codes from here on are territories.
FIRST_TERRITORY = 60


def areas_below(
    areas: DataFrame,
    level: str,
    state: str | None = None,
    county: str | None = None,
    tract: str | None = None,
) -> DataFrame:
    """Areas of a level, everywhere or inside a state, county or tract.

    ``areas`` has ``level`` and ``geoid``; the filters reach the scan as an equality on
    the level (a partition column of landed tables) and a prefix of the id.
    """
    out = areas.where(F.col("level") == level)
    parts = [(state, 2), (county, 3), (tract, 6)]
    prefix = ""
    for value, width in parts:
        if value is None:
            break
        prefix += str(value).rjust(width, "0")
    given = [value for value, _ in parts]
    if any(v is not None for v in given[given.index(None) :] if None in given):
        raise ValueError("a county needs its state, a tract needs its county")
    return out.where(F.col("geoid").startswith(prefix)) if prefix else out


def without_territories(df: DataFrame, state: str) -> DataFrame:
    return df.where(F.col(state).cast("int") < FIRST_TERRITORY)


def national(areas: DataFrame, level: str) -> DataFrame:
    """All areas of a level in the states proper."""
    below = areas_below(areas, level).withColumn("_state", ids.parent_id("geoid", "state"))
    return without_territories(below, "_state").drop("_state")


def walk(children: DataFrame, parents: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Areas whose chain of parents is present in the parent tables.

    ``parents`` lists ``(table, keys)`` from the lowest parent up, as in
    ``[(tracts, ['state', 'county', 'tract']), (counties, ['state', 'county'])]``.
    """
    out = children
    for table, keys in parents:
        out = out.join(table.select(*keys), keys, "left_semi")
    return out


def ids_per_parent(df: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Distinct child ids below each parent, one row per pair."""
    return df.select(*parent, child).distinct()
