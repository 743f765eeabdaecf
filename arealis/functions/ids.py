"""Area identifiers: padding, prefixes, level codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealis.functions.numbers import col

# Level names and their three-digit codes.
LEVEL_CODES = {
    "united states": "010",
    "us": "010",
    "state": "040",
    "county": "050",
    "county subdivision": "060",
    "tract": "140",
    "block group": "150",
    "bg": "150",
    "place": "160",
    "american indian area": "250",
    "metropolitan statistical area": "310",
    "micropolitan statistical area": "310",
    "msa": "310",
    "congressional district": "500",
    "congress": "500",
    "5-digit zip code tabulation area": "860",
    "zcta": "860",
    "zip": "860",
}

# Level codes and their short type names.
LEVEL_TYPES = {
    "010": "us",
    "040": "state",
    "050": "county",
    "060": "cnysub",
    "140": "tract",
    "150": "blkgrp",
    "160": "place",
    "250": "amindland",
    "310": "msa",
    "500": "congress",
    "860": "zcta",
}

# Levels whose ids nest by prefix, and the width of the id at each of them.
ID_WIDTHS = {"state": 2, "county": 5, "tract": 11, "block group": 12, "block": 15}


def pad_left(c: Column | str, width: int) -> Column:
    """Pad with zeros to at least ``width``; longer text stays whole (``lpad`` would cut it)."""
    text = col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def short_id(long_id: Column | str) -> Column:
    """The part of a long id after ``US`` (``1400000US01001000100`` -> ``01001000100``)."""
    parts = F.split(col(long_id), "US")
    return F.get(parts, F.lit(1))


def state_of(long_id: Column | str) -> Column:
    return F.substring(short_id(long_id), 1, 2)


def level_code_of(long_id: Column | str) -> Column:
    return F.substring(col(long_id), 1, 3)


def level_code(level: str) -> str:
    """Code of a level given by name (any case) or by code."""
    name = str(level).lower()
    if name in LEVEL_CODES:
        return LEVEL_CODES[name]
    if str(level) in LEVEL_TYPES:
        return str(level)
    raise ValueError(f"unknown level {level!r}; names: {sorted(LEVEL_CODES)}")


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def level_code_column(level: Column | str) -> Column:
    name = F.lower(col(level))
    return F.coalesce(
        _lookup(LEVEL_CODES, name), F.when(name.isin(*LEVEL_TYPES), name)
    )


def level_type_column(code: Column | str) -> Column:
    return _lookup(LEVEL_TYPES, col(code))


def parent_id(geoid: Column | str, level: str) -> Column:
    """Id of the enclosing area: ids of nested levels share their prefix."""
    return F.substring(col(geoid), 1, ID_WIDTHS[level])


def ends_in_digit(c: Column | str) -> Column:
    return col(c).rlike("[0-9]$")
