"""Map layer features (attributes and raw geometry) from landed JSON.

The common geometry is a struct ``(kind, rings)``: rings of points for a polygon, paths
for a line, one list of points for points. A point is a struct ``(x, y)``, with ``z`` and
``m`` on request.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.sources.catalogue import documents

_POINT = T.ArrayType(T.DoubleType())
_POINTS = T.ArrayType(_POINT)
_NUMBER = T.DoubleType()

# Type names of a map service and the kinds of geometry they mean.
GEOMETRY_KINDS = {
    "esriGeometryPolygon": "MultiPolygon",
    "esriGeometryPolyline": "MultiLineString",
    "esriGeometryPoint": "Point",
    "esriGeometryMultipoint": "MultiPoint",
}

_RAW_GEOMETRY = T.StructType(
    [
        T.StructField("rings", T.ArrayType(_POINTS)),
        T.StructField("paths", T.ArrayType(_POINTS)),
        T.StructField("points", _POINTS),
        T.StructField("x", _NUMBER),
        T.StructField("y", _NUMBER),
        T.StructField("z", _NUMBER),
        T.StructField("m", _NUMBER),
    ]
)
_REFERENCE = T.StructType(
    [T.StructField("wkid", T.IntegerType()), T.StructField("latestWkid", T.IntegerType())]
)


def _layer_schema(attributes: T.DataType) -> T.StructType:
    feature = T.StructType(
        [
            T.StructField("attributes", attributes),
            T.StructField("geometry", _RAW_GEOMETRY),
            T.StructField("x", _NUMBER),
            T.StructField("y", _NUMBER),
        ]
    )
    return T.StructType(
        [
            T.StructField("geometryType", T.StringType()),
            T.StructField("spatialReference", _REFERENCE),
            T.StructField("features", T.ArrayType(feature)),
        ]
    )


def _point(p: Column, z: bool, m: bool) -> Column:
    parts = [F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")]
    if z:
        parts.append(F.get(p, F.lit(2)).alias("z"))
    if m:
        parts.append(F.get(p, F.lit(3 if z else 2)).alias("m"))
    return F.struct(*parts)


def geometry(
    raw: Column, geometry_type: Column, x: Column, y: Column, z: bool = False, m: bool = False
) -> Column:
    """Raw geometry of any type -> ``struct(kind, rings)``.

    A point may carry its coordinates in its geometry or at the top of the record.
    """
    pairs = [F.lit(v) for kv in GEOMETRY_KINDS.items() for v in kv]
    kind = F.try_element_at(F.create_map(*pairs), geometry_type)
    single = [F.coalesce(raw["x"], x).alias("x"), F.coalesce(raw["y"], y).alias("y")]
    single += [raw["z"].alias("z")] * z + [raw["m"].alias("m")] * m
    lists = F.coalesce(
        raw["rings"], raw["paths"], F.when(raw["points"].isNotNull(), F.array(raw["points"]))
    )
    structured = F.transform(lists, lambda ring: F.transform(ring, lambda p: _point(p, z, m)))
    rings = F.coalesce(structured, F.array(F.array(F.struct(*single))))
    return F.struct(kind.alias("kind"), rings.alias("rings"))


def _feature_type(attributes: Mapping[str, str]) -> T.StructType:
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in attributes.items())
    return _layer_schema(T.StructType.fromDDL(ddl))


def parsed_layers(docs: DataFrame, attributes: Mapping[str, str]) -> DataFrame:
    """Layer texts ``(path, value)`` with their content ``j`` and reference system ``srid``."""
    parsed = docs.withColumn("j", F.from_json("value", _feature_type(attributes)))
    return parsed.withColumn("srid", F.coalesce("j.spatialReference.latestWkid", "j.spatialReference.wkid"))


def _with_geometry(rows: DataFrame, z: bool, m: bool) -> DataFrame:
    """Features ``f`` with the ``type`` and ``srid`` of their layer -> attributes, ``srid``, ``geometry``."""
    shape = geometry(F.col("f.geometry"), F.col("type"), F.col("f.x"), F.col("f.y"), z, m)
    return rows.select("f.attributes.*", "srid", shape.alias("geometry"))


def shaped(texts: DataFrame, attributes: Mapping[str, str], z: bool = False, m: bool = False) -> DataFrame:
    """Texts of single features with the ``type`` and ``srid`` of their layer -> rows; others are left out."""
    one = _feature_type(attributes)["features"].dataType.elementType
    rows = texts.select("type", "srid", F.from_json("value", one).alias("f"))
    return _with_geometry(rows.where("f.attributes IS NOT NULL"), z, m)


def parse_features(
    docs: DataFrame, attributes: Mapping[str, str], z: bool = False, m: bool = False
) -> DataFrame:
    """Layer files -> attributes with declared types, ``srid`` and ``geometry``."""
    rows = parsed_layers(docs, attributes).select(
        F.col("j.geometryType").alias("type"), "srid", F.explode("j.features").alias("f")
    )
    return _with_geometry(rows, z, m)


def read_features(
    spark: SparkSession, path: str, attributes: Mapping[str, str], per_line: bool = False, **options
) -> DataFrame:
    return parse_features(documents(spark, path, per_line), attributes, **options)
