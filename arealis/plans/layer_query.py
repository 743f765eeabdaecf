"""Query of a map layer: rows, fields, geometry options, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions import shapes
from arealis.functions.text import best_name
from arealis.operators.select import require_columns
from arealis.operators.spatial import BY_BOX, RELATIONS, areas_in_box, spatial_filter

STATISTICS = {
    "count": F.count,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "stddev": F.stddev,
    "var": F.variance,
}

Box = tuple[float, float, float, float]


@dataclass(frozen=True)
class Layer:
    """A layer table and what its columns mean."""

    df: DataFrame
    name: str = ""
    key: str = "OBJECTID"
    rings: str = "rings"
    display: str = "NAME"
    time: str | None = None
    srid: int = shapes.WEB_MERCATOR
    closed: bool = True  # rings of polygons, not paths of lines

    def query(
        self,
        where: str = "",
        text: str = "",
        time: tuple | None = None,
        object_ids: Sequence = (),
        geometry: Box | Sequence | None = None,
        spatial_rel: str = "intersects",
        relation_param: str | None = None,
        in_srid: int | None = None,
        out_fields: str | Sequence[str] = "*",
        return_geometry: bool = True,
        geometry_precision: int | None = None,
        max_allowable_offset: float | None = None,
        out_srid: int | None = None,
        return_ids_only: bool = False,
        return_count_only: bool = False,
        return_distinct: bool = False,
        order_by: Sequence[str] = (),
        group_by: Sequence[str] = (),
        statistics: Sequence[tuple[str, str, str]] = (),
    ) -> DataFrame:
        """Rows of the layer.

        ``where`` is Spark SQL. ``geometry`` is a box ``(xmin, ymin, xmax, ymax)`` or a
        shape given as a list of rings, in ``in_srid`` if that differs from the layer's;
        ``relation_param`` is the pattern of the ``spatial_rel`` named ``relation``.
        ``statistics`` lists ``(statistic, field, name)`` per ``group_by``. ``order_by``
        takes names, with ``DESC`` after a name where wanted.
        """
        df = self._rows(where, text, time, object_ids)
        if geometry is not None:
            df = self._near(df, geometry, spatial_rel, in_srid or self.srid, relation_param)
        if return_count_only:
            return df.agg(F.count("*").alias("count"))
        if return_ids_only:
            return _ordered(df, order_by).select(self.key)
        if statistics:
            columns = [STATISTICS[s.lower()](F.col(f)).alias(n) for s, f, n in statistics]
            return _ordered(df.groupBy(*group_by).agg(*columns), order_by)
        df = _ordered(df, order_by)
        fields = [c for c in df.columns if c != self.rings]
        if out_fields != "*":
            fields = [f.strip() for f in out_fields.split(",")] if isinstance(out_fields, str) else list(out_fields)
            require_columns(df, fields)
        if return_distinct or not return_geometry or self.rings not in df.columns:
            out = df.select(*fields)
            if return_distinct:
                require_columns(out, _names(order_by))  # an order by what was left out has no meaning
            # distinct shuffles, so the order has to come after it
            return _ordered(out.distinct(), order_by) if return_distinct else out
        shape = F.col(self.rings)
        if max_allowable_offset:
            shape = shapes.simplify(shape, max_allowable_offset, self.closed)
        if out_srid and out_srid != self.srid:
            shape = shapes.reproject(shape, self.srid, out_srid)
        if geometry_precision is not None:
            shape = shapes.round_points(shape, geometry_precision)
        return df.select(*fields, shape.alias(self.rings))

    def _rows(self, where: str, text: str, time: tuple | None, object_ids: Sequence) -> DataFrame:
        df = self.df.where(where) if where else self.df
        if text:
            df = df.where(F.col(self.display).contains(text))
        if time:
            if self.time is None:
                raise ValueError("the layer has no time column")
            df = df.where(F.col(self.time).between(*time))
        if object_ids:
            df = df.where(F.col(self.key).isin(*object_ids))
        return df

    def _near(self, df: DataFrame, geometry, relation: str, srid: int, pattern: str | None) -> DataFrame:
        if relation not in RELATIONS:
            raise ValueError(f"spatial_rel must be one of {RELATIONS}")
        spark = df.sparkSession
        if isinstance(geometry[0], (int, float)):
            xmin, ymin, xmax, ymax = geometry
            if srid == self.srid and relation in ("intersects", "within", *BY_BOX):
                return areas_in_box(df, geometry, relation, self.rings)
            geometry = [[(xmin, ymin), (xmin, ymax), (xmax, ymax), (xmax, ymin)]]
        return spatial_filter(
            spark, df, self.key, geometry, relation, self.rings, srid, self.srid, pattern
        )


def _listed(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def _names(order_by: str | Sequence[str]) -> list[str]:
    return [name.strip().partition(" ")[0] for name in _listed(order_by)]


def _ordered(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    if not order_by:
        return df
    keys = []
    for name in _listed(order_by):
        field, _, way = name.strip().partition(" ")
        keys.append(F.desc(field) if way.strip().lower() == "desc" else F.asc(field))
    return df.orderBy(*keys)


def service_layer(layers: Sequence[Layer], layer: int | str) -> Layer:
    """A layer of a service by its number or by the best match of its name."""
    if isinstance(layer, int):
        return layers[layer]
    return layers[best_name([x.name for x in layers], layer)]
