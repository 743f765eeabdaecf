"""Query of one table of area estimates: columns, level, parents, further predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.operators.select import any_of, key_first, require_columns, to_numbers, where_all


def table_query(
    table: DataFrame,
    cols: str | Sequence[str],
    geo_unit: str = "",
    geo_filter: Mapping[str, str | Sequence[str]] | None = None,
    convert_numeric: bool = True,
    index: str = "",
    types: Mapping[str, str | None] | None = None,
    **predicates: str,
) -> DataFrame:
    """Columns of the areas of one level.

    ``geo_unit`` is ``level``, ``level:*`` or ``level:id,id``; ``geo_filter`` restricts to
    parents (``{'state': '04', 'county': '019,021'}``); further keywords are predicates
    where ``*`` means any value. The id columns named in ``geo_unit`` and ``geo_filter``
    follow the chosen columns. ``types`` are those of the variable dictionary (see
    :func:`~arealis.operators.select.to_numbers`). All filters reach the scan; an empty result stays an empty
    table.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    geo_filter = dict(geo_filter or {})
    require_columns(table, cols)
    level, _, wanted = geo_unit.partition(":")
    out = table
    if level:
        if "level" in table.columns:
            out = out.where(F.col("level") == level)
        condition = any_of(level, wanted) if wanted and level in table.columns else None
        out = out if condition is None else out.where(condition)
    out = where_all(where_all(out, geo_filter), predicates)
    id_columns = [*geo_filter, *([level] if level in table.columns else [])]
    out = out.select(*cols, *[c for c in dict.fromkeys(id_columns) if c not in cols])
    if convert_numeric:
        out = to_numbers(out, cols, types)
    return key_first(out, index) if index else out
