"""Assembly of raw rings into polygons: which hole belongs to which outer ring.

The work runs on a table of rings. Every step is keyed by the feature, and holes meet
only those outer rings whose box and edges lie at their height.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions import shapes, unions
from arealis.operators.spatial import POINT_BOX, band_count, box_pairs, points_inside


def ring_table(df: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """One row per ring: ``(key, kind, ring, points, outer, area)``; ``outer`` tells that it is
    a clockwise ring, or that the feature has none. ``kind`` is that of the feature."""
    # areas are worked out once, in the feature's row, before it is unfolded
    area = shapes.signed_area_sql("r")
    measured = f"transform({rings}, r -> named_struct('points', r, 'area', {area}))"
    outers = "size(filter(ms, m -> m.area < 0))"
    marked = "transform(ms, m -> named_struct('m', m, 'outers', outers, 'rings', size(ms)))"
    unfolded = shapes.bind_sql(measured, "ms", shapes.bind_sql(outers, "outers", marked))
    flat = df.select(key, F.posexplode(F.expr(unfolded)).alias("ring", "_r"))
    return flat.select(
        key,
        shapes.kind_of(F.col("_r.rings"), F.col("_r.outers")).alias("kind"),
        "ring",
        "_r.m.points",
        F.expr("_r.m.area < 0 OR _r.outers = 0").alias("outer"),
        F.expr("abs(_r.m.area)").alias("area"),
    )


def _containers(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Pairs ``(key, ring, shell, shell_area)`` with a point of the ring inside the shell,
    for shells at least as large as the ring (so a shell inside a hole does not own it)."""
    point = F.get(shapes.interior_points("array(points)"), F.lit(0))
    spots = inner.select(key, "ring", "area", point.alias("p")).select(
        key, "ring", "area", "p.x", "p.y"
    ).withColumn("box", F.expr(POINT_BOX))
    shells = outer.select(
        key,
        F.col("ring").alias("shell"),
        F.col("area").alias("shell_area"),
        F.array("points").alias("rings"),
    )
    boxed = shells.select(
        key,
        "shell",
        "shell_area",
        band_count("rings").alias("bands"),
        shapes.bounds("rings").alias("box"),
    )
    # the rings of a feature came from one row: no key is crowded, so nothing is salted
    near = box_pairs(spots, boxed, on=[key], points=True, salts=1).where(
        (F.col("shell_area") >= F.col("area")) & (F.col("shell") != F.col("ring"))
    )
    found = points_inside(near, shells, [key, "shell"], salts=1)
    return found.select(key, "ring", "shell", "shell_area")


def shell_order(rings: DataFrame, key: str) -> DataFrame:
    """Outer rings with the number of other outer rings inside them, fewest first:
    ``(key, ring, holds, rank)``."""
    outer = rings.where("outer")
    held = _containers(outer, outer, key).groupBy(key, F.col("shell").alias("ring")).agg(
        F.count("*").alias("holds")
    )
    # as many as there are rings: the bytes of their counts would pass for few
    counted = outer.select(key, "ring").join(held.hint("merge"), [key, "ring"], "left")
    holds = F.coalesce("holds", F.lit(0)).alias("holds")
    rank = F.row_number().over(Window.partitionBy(key).orderBy("holds", "ring"))
    return counted.select(key, "ring", holds).withColumn("rank", rank)


def _parts_sql(rings: str, repair: bool) -> str:
    """``named_struct('outers', 'parts')`` of the raw rings, worked out in the feature's row."""
    bind = shapes.bind_sql
    measured = f"transform({rings}, (r, ri) -> named_struct('i', ri, 'points', r, 'area', {shapes.signed_area_sql('r')}))"
    shells = "if(outers = 0, ms, filter(ms, m -> m.area < 0))"
    holes = "if(outers = 0, slice(ms, 1, 0), filter(ms, m -> m.area >= 0))"
    before = "array_max(transform(filter(os, oo -> oo.i < hh.i), oo -> oo.i))"
    owner = f"coalesce({before}, get(os, 0).i)"
    if repair:
        box = "named_struct('i', oo.i, 'area', -oo.area, 'es', {}, 'box', {})".format(
            shapes.ring_edges_sql("oo.points"), shapes.bounds_sql("array(oo.points)")
        )
        in_box = "pt.x BETWEEN bb.box.xmin AND bb.box.xmax AND pt.y BETWEEN bb.box.ymin AND bb.box.ymax"
        holds = f"bb.area >= hh.area AND {in_box} AND {shapes.inside_sql('bb.es', 'pt.x', 'pt.y')}"
        around = f"filter(bs, bb -> coalesce({holds}, false))"
        innermost = f"array_min(transform({around}, bb -> named_struct('area', bb.area, 'i', bb.i))).i"
        point = f"get({shapes.interior_points_sql('array(hh.points)')}, 0)"
        owner = f"coalesce({bind(point, 'pt', innermost)}, {owner})"
        boxes = f"if(outers > 1 AND outers < size(ms), transform(os, oo -> {box}), NULL)"
    owned = f"transform({holes}, hh -> named_struct('owner', {owner}, 'points', hh.points))"
    if repair:
        owned = bind(boxes, "bs", owned)
    part = "concat(array(oo.points), transform(filter(hs, hx -> hx.owner = oo.i), hx -> hx.points))"
    parts = bind(owned, "hs", f"transform(os, oo -> {part})")
    both = f"named_struct('outers', outers, 'parts', {bind(shells, 'os', parts)})"
    return bind(measured, "ms", bind("size(filter(ms, m -> m.area < 0))", "outers", both))


def _united(holes: Column) -> Column:
    """For each part its holes, united, and the parts that fill their gaps; both as JSON."""

    def of_part(rings: list) -> list:
        parts = unions.united([[(p["x"], p["y"]) for p in ring] for ring in rings]) if rings else [[]]
        return [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]

    @F.pandas_udf("string")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: json.dumps([of_part(rings) for rings in json.loads(t)]), na_action="ignore")

    return found(holes)


def _unite(df: DataFrame, parts: str) -> DataFrame:
    """``df`` with parts whose holes overlap nowhere; features without such holes send nothing to Python."""
    meet = "o.xmin <= b.xmax AND o.xmax >= b.xmin AND o.ymin <= b.ymax AND o.ymax >= b.ymin"
    crowded = f"exists(transform(bs, (b, bi) -> exists(slice(bs, bi + 2, size(bs)), o -> {meet})), x -> x)"
    boxes = f"transform(slice(p, 2, greatest(size(p) - 1, 0)), h -> {shapes.bounds_sql('array(h)')})"
    todo = shapes.bind_sql(boxes, "bs", crowded)
    holes = f"transform({parts}, p -> if(size(p) > 2 AND {todo}, slice(p, 2, greatest(size(p) - 1, 0)), slice(p, 1, 0)))"
    some = shapes.bind_sql(holes, "hs", "if(exists(hs, h -> size(h) > 0), hs, NULL)")

    def one(part: Column, found: Column) -> Column:
        first = F.concat(F.slice(part, 1, 1), F.get(found, F.lit(0)))
        more = F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0)))
        as_before = found.isNull() | (F.size(F.get(found, F.lit(0))) == 0)
        return F.when(as_before, F.array(part)).otherwise(F.concat(F.array(first), more))

    kind = T.ArrayType(df.schema[parts].dataType)  # what else points have is missing in new ones
    nothing = F.array().cast(kind)
    sent = df.withColumn("_some", F.expr(f"to_json({some})"))
    # asked for twice, the text is a column of its own, which is what the function can take
    text = F.when(F.col("_some").isNotNull(), _united(F.col("_some")))
    found = sent.withColumn("_new", F.coalesce(F.from_json(text, kind), nothing))
    return found.withColumn(parts, F.flatten(F.zip_with(parts, "_new", one))).drop("_some", "_new")


def assemble(df: DataFrame, key: str, rings: str = "rings", repair: bool = True) -> DataFrame:
    """Raw rings -> ``(key, kind, parts)``, ``parts`` as ``array<array<ring>>`` with the outer
    ring first in each part.

    Without ``repair`` holes belong to the last outer ring before them. With it, in
    features with several outer rings and holes, each goes to the innermost outer ring
    that contains it; holes of an outer ring that overlap are united, and a gap that they leave is
    a part of its own. All rings of a feature lie in one row, so this is done in the row, after the rows
    are dealt over the tasks by their key.
    """
    some = df.select(key, F.col(rings).alias("_rings")).where("size(_rings) > 0")
    if repair:  # features cost far more than their bytes, by which files are split
        some = some.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    rows = some.select(key, F.size("_rings").alias("_n"), F.expr(_parts_sql("_rings", repair)).alias("_b"))
    kind = shapes.kind_of(F.col("_n"), F.col("_b.outers"))
    if not repair:
        return rows.select(key, kind.alias("kind"), "_b.parts")
    before = rows.select(key, kind.alias("_kind"), F.col("_b.parts").alias("parts"))
    out = _unite(before.withColumn("_count", F.size(F.flatten("parts"))), "parts")
    count = F.size(F.flatten("parts"))
    again = F.when(count != F.col("_count"), shapes.kind_of(count, F.size("parts"))).otherwise(F.col("_kind"))
    return out.select(key, again.alias("kind"), "parts")


def with_united_holes(df: DataFrame, rings: str = "rings") -> DataFrame:
    """The table with holes that overlap united, so that a place in several of them is outside.

    Rings come in the order of the assembled parts; a table without rings keeps its row.
    """
    built = df.withColumn("_b", F.expr(_parts_sql(rings, True))).withColumn("_parts", F.col("_b.parts"))
    flat = F.flatten("_parts")
    return _unite(built, "_parts").withColumn(rings, F.when(F.size(flat) > 0, flat).otherwise(F.col(rings))).select(*df.columns)
