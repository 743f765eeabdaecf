"""Shapes: boxes and triangles on a grid, areas of growing number among them."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import shapes
from arealis.operators import spatial
from workload.tables import table

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def grid(spark, sf):
    nation, key = table(spark, sf, "nation"), F.col("n_nationkey")
    return nation.select(
        key.alias("oid"),
        ((key % 5) * 100.0).alias("x0"),
        (F.floor(key / 5.0) * 100.0).alias("y0"),
    )


def areas(spark, sf):
    """Small boxes, one per customer, some across the edges of the grid."""
    customer, key = table(spark, sf, "customer"), F.col("c_custkey")
    df = customer.select(
        key.alias("aid"),
        ((key * 37) % 480).cast("double").alias("x0"),
        ((key * 53) % 470).cast("double").alias("y0"),
        (10.0 + key % 15).alias("w"),
    )
    x0, y0, w = F.col("x0"), F.col("y0"), F.col("w")
    return df.withColumn("rings", F.array(shapes.box_rings(x0, y0, x0 + w, y0 + w)))


def boxes(spark, sf):
    x0, y0 = F.col("x0"), F.col("y0")
    return grid(spark, sf).withColumn("rings", F.array(shapes.box_rings(x0, y0, x0 + 100, y0 + 100)))


def holed(spark, sf):
    """Boxes of the grid with a hole from a quarter to three quarters of the side."""
    x0, y0 = F.col("x0"), F.col("y0")
    outer = shapes.box_rings(x0, y0, x0 + 100, y0 + 100)
    hole = shapes.box_rings(x0 + 25, y0 + 25, x0 + 75, y0 + 75, clockwise=False)
    return grid(spark, sf).withColumn("rings", F.array(outer, hole))


def triangles(spark, sf):
    """Right triangles below the falling diagonal of each box of the grid."""
    x0, y0 = F.col("x0"), F.col("y0")
    points = [(x0, y0), (x0, y0 + 100), (x0 + 100, y0)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])
    return grid(spark, sf).withColumn("rings", F.array(ring))


SHAPES_SQL = """
o AS (SELECT n_nationkey AS oid, (n_nationkey % 5) * 100.0e0 AS x0, floor(n_nationkey / 5.0e0) * 100 AS y0 FROM nation),
a AS (SELECT c_custkey AS aid, ((c_custkey * 37) % 480)::double AS ax, ((c_custkey * 53) % 470)::double AS ay,
             10.0e0 + c_custkey % 15 AS w FROM customer),
p AS (SELECT *, ax >= x0 AND ay >= y0 AND ax + w <= x0 + 100 AND ay + w <= y0 + 100 AS within_box,
             ax <= x0 + 100 AND ay <= y0 + 100 AND ax + w >= x0 AND ay + w >= y0 AS meets_box,
             ax < x0 + 75 AND ay < y0 + 75 AND ax + w > x0 + 25 AND ay + w > y0 + 25 AS enters_hole,
             greatest(ax, x0) + greatest(ay, y0) - x0 - y0 <= 100 AS low_corner_below,
             ax + w + ay + w - x0 - y0 <= 100 AS high_corner_below
      FROM a, o)"""


@query(
    "box_texts",
    f"""WITH {SHAPES_SQL} SELECT aid, printf('%.6f,%.6f,%.6f,%.6f', ax, ay, ax + w, ay + w) AS box FROM a""",
)
def _(spark, sf):
    return areas(spark, sf).select("aid", shapes.box_text(shapes.bounds("rings")).alias("box"))


@query("within_boxes", f"WITH {SHAPES_SQL} SELECT aid, oid FROM p WHERE within_box")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), boxes(spark, sf), "aid", "oid")


@query("within_holed_boxes", f"WITH {SHAPES_SQL} SELECT aid, oid FROM p WHERE within_box AND NOT enters_hole")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), holed(spark, sf), "aid", "oid")


@query("within_triangles", f"WITH {SHAPES_SQL} SELECT aid, oid FROM p WHERE within_box AND high_corner_below")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), triangles(spark, sf), "aid", "oid")


@query("intersects_triangles", f"WITH {SHAPES_SQL} SELECT aid, oid FROM p WHERE meets_box AND low_corner_below")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), triangles(spark, sf), "aid", "oid", "intersects")


@query("outlines_containing_areas", f"WITH {SHAPES_SQL} SELECT oid, aid FROM p WHERE within_box AND high_corner_below")
def _(spark, sf):
    return spatial.relate(triangles(spark, sf), areas(spark, sf), "oid", "aid", "contains")


@query(
    "areas_within_any_outline",
    f"WITH {SHAPES_SQL} SELECT DISTINCT aid, w FROM p WHERE within_box AND NOT enters_hole",
)
def _(spark, sf):
    return spatial.areas_within(areas(spark, sf), holed(spark, sf), "aid", "oid").select("aid", "w")


@query(
    "areas_meeting_box",
    f"""WITH {SHAPES_SQL} SELECT aid, w FROM a WHERE ax <= 240.5 AND ay <= 333.25 AND ax + w >= 90.5 AND ay + w >= 120.25""",
)
def _(spark, sf):
    return spatial.areas_in_box(areas(spark, sf), (90.5, 120.25, 240.5, 333.25)).select("aid", "w")


@query(
    "layer_clustered_by_position",
    f"""WITH {SHAPES_SQL} SELECT aid, w, (aid % 3)::int AS part FROM a
      WHERE ax <= 240.5 AND ay <= 333.25 AND ax + w >= 90.5 AND ay + w >= 120.25 AND aid % 3 < 2""",
)
def _(spark, sf):
    from arealis.session import scratch_path
    from arealis.sources import landed

    path = scratch_path(spark, "layer")
    landed.write_layer(areas(spark, sf).withColumn("part", F.col("aid") % 3), path, "part")
    layer = spark.read.parquet(path).where("part < 2")
    return spatial.areas_in_box(layer, (90.5, 120.25, 240.5, 333.25)).select("aid", "w", "part")


@query(
    "triangles_meeting_box",
    f"""WITH {SHAPES_SQL} SELECT oid FROM o WHERE x0 <= 240.5 AND y0 <= 333.25 AND x0 + 100 >= 160.5 AND y0 + 100 >= 180.25
      AND greatest(x0, 160.5) + greatest(y0, 180.25) - x0 - y0 <= 100""",
)
def _(spark, sf):
    return spatial.areas_in_box(triangles(spark, sf), (160.5, 180.25, 240.5, 333.25)).select("oid")


@query(
    "areas_within_given_shape",
    f"""WITH {SHAPES_SQL} SELECT aid FROM a WHERE ax >= 50 AND ay >= 50 AND ax + w + ay + w <= 450""",
)
def _(spark, sf):
    shape = [[(50, 50), (50, 400), (400, 50)]]
    return spatial.spatial_filter(spark, areas(spark, sf), "aid", shape, "within").select("aid")


@query(
    "points_within_outlines",
    f"""WITH {SHAPES_SQL} SELECT aid, oid FROM a, o WHERE ax > x0 AND ay > y0 AND ax < x0 + 100 AND ay < y0 + 100
      AND NOT (ax BETWEEN x0 + 25 AND x0 + 75 AND ay BETWEEN y0 + 25 AND y0 + 75)""",
)
def _(spark, sf):
    point = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y"))
    points = areas(spark, sf).select("aid", F.array(F.array(point)).alias("rings"))
    return spatial.relate(points, holed(spark, sf), "aid", "oid")


@query(
    "bounds_of_areas",
    f"WITH {SHAPES_SQL} SELECT min(ax) AS xmin, min(ay) AS ymin, max(ax + w) AS xmax, max(ay + w) AS ymax FROM a",
)
def _(spark, sf):
    return spatial.total_bounds(areas(spark, sf))


# --- rings ---------------------------------------------------------------------------------


def nested(spark, sf):
    """Per customer eight-fold geometry: by its number one of four kinds, rings shuffled.

    0 a box, 1 a box with a hole, 2 two boxes, 3 an outer box with a hole that holds an
    inner box with a hole, the holes listed after both boxes, inner one first.
    """
    customer, key = table(spark, sf, "customer"), F.col("c_custkey")
    x, y = ((key * 37) % 480).cast("double"), ((key * 53) % 470).cast("double")

    def box(inset, turn=True, shift=0.0):
        return shapes.box_rings(x + inset + shift, y + inset, x + 80 - inset + shift, y + 80 - inset, turn)

    outer, hole, inner, pit = box(0), box(10, False), box(20), box(30, False)
    rings = (
        F.when(key % 4 == 0, F.array(outer))
        .when(key % 4 == 1, F.array(outer, hole))
        .when(key % 4 == 2, F.array(outer, box(0, True, 100.0)))
        .otherwise(F.array(outer, inner, pit, hole))
    )
    return customer.select(key.alias("fid"), rings.alias("rings"))


@query(
    "rings_assembled",
    """SELECT c_custkey AS fid, CASE c_custkey % 4 WHEN 0 THEN 'Polygon' WHEN 1 THEN 'Polygon with Holes'
      WHEN 2 THEN 'MultiPolygon' ELSE 'MultiPolygon with Holes' END AS kind,
    CASE c_custkey % 4 WHEN 0 THEN '80' WHEN 1 THEN '80,60' WHEN 2 THEN '80;80' ELSE '80,60;40,20' END AS sides
    FROM customer""",
)
def _(spark, sf):
    from arealis.operators import rings

    out = rings.assemble(nested(spark, sf), "fid")

    def side(ring):
        xs = F.transform(ring, lambda p: p["x"])
        return (F.array_max(xs) - F.array_min(xs)).cast("long").cast("string")

    sides = F.transform("parts", lambda part: F.array_join(F.transform(part, side), ","))
    return out.select("fid", "kind", F.array_join(sides, ";").alias("sides"))


@query(
    "shell_order",
    """SELECT c_custkey AS fid, ring::int AS ring, CASE WHEN c_custkey % 4 = 3 AND ring = 0 THEN 1 ELSE 0 END::bigint AS holds,
      CASE WHEN c_custkey % 4 < 2 THEN 1 WHEN c_custkey % 4 = 2 THEN ring + 1 ELSE 2 - ring END::int AS rank
    FROM customer, (VALUES (0), (1)) AS t(ring) WHERE ring = 0 OR c_custkey % 4 >= 2""",
)
def _(spark, sf):
    from arealis.operators import rings

    return rings.shell_order(rings.ring_table(nested(spark, sf), "fid"), "fid")


@query(
    "ring_turns_and_areas",
    """SELECT c_custkey AS fid, CASE c_custkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'true,false' WHEN 2 THEN 'true,true'
      ELSE 'true,true,false,false' END AS turns,
    CASE c_custkey % 4 WHEN 0 THEN 6400 WHEN 1 THEN 2800 WHEN 2 THEN 12800 ELSE 4000 END::double AS area FROM customer""",
)
def _(spark, sf):
    turns = F.transform(shapes.ring_turns("rings"), lambda t: t.cast("string"))
    areas_ = shapes.covered_area("rings")
    return nested(spark, sf).select("fid", F.array_join(turns, ",").alias("turns"), areas_.alias("area"))


@query(
    "features_read",
    """SELECT s_suppkey::varchar AS "GEOID", s_name AS "NAME", 3857 AS srid,
      CASE s_suppkey % 3 WHEN 0 THEN 'MultiPolygon' WHEN 1 THEN 'MultiLineString' ELSE 'Point' END AS kind,
      CASE s_suppkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END AS points,
      s_suppkey + 0.25e0 AS x FROM supplier""",
)
def _(spark, sf):
    from arealis.sources import features
    from workload.landing import land_text

    key = F.col("s_suppkey")
    x, y = key + 0.25, key + 0.5
    corners = F.array(F.array(x, y), F.array(x, y + 9), F.array(x + 9, y + 9), F.array(x + 9, y))
    kind = key % 3
    geometry = F.struct(
        F.when(kind == 0, F.array(corners)).alias("rings"),
        F.when(kind == 1, F.array(F.slice(corners, 1, 2))).alias("paths"),
        F.when(kind == 2, x).alias("x"),
        F.when(kind == 2, y).alias("y"),
    )
    attributes = F.struct(key.cast("string").alias("GEOID"), F.col("s_name").alias("NAME"))
    layer = F.struct(
        F.when(kind == 0, "esriGeometryPolygon")
        .when(kind == 1, "esriGeometryPolyline")
        .otherwise("esriGeometryPoint")
        .alias("geometryType"),
        F.struct(F.lit(102100).alias("wkid"), F.lit(3857).alias("latestWkid")).alias("spatialReference"),
        F.array(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("features"),
    )
    docs = table(spark, sf, "supplier").select(F.to_json(layer).alias("value"))
    path = land_text(docs, spark, "features")
    df = features.read_features(spark, path, {"GEOID": "string", "NAME": "string"}, per_line=True)
    points = F.flatten("geometry.rings")
    return df.select(
        "GEOID", "NAME", "srid", "geometry.kind", F.size(points).alias("points"), F.get(points, F.lit(0))["x"].alias("x")
    )


@query(
    "features_with_z",
    """SELECT s_suppkey::varchar AS id, round(degrees(1000 * s_suppkey / 6378137.0), 6) AS lon,
      round(degrees(2 * atan(exp(2000 / 6378137.0)) - pi() / 2), 6) AS lat, s_suppkey + 0.123456789e0 AS z, s_suppkey * 10.0e0 AS m, 1 AS points
    FROM supplier""",
)
def _(spark, sf):
    """Points with height and measure: simplified, reprojected and rounded."""
    from arealis.sources import features
    from workload.landing import land_text

    key = F.col("s_suppkey")
    number = lambda c: c.cast("double")
    path = F.array(F.array(number(key * 1000), F.lit(2000.0), key + 0.123456789, number(key * 10)))
    feature = F.struct(F.struct(key.cast("string").alias("id")).alias("attributes"), F.struct(F.array(path).alias("paths")).alias("geometry"))
    layer = F.struct(
        F.lit("esriGeometryPolyline").alias("geometryType"),
        F.struct(F.lit(3857).alias("latestWkid")).alias("spatialReference"),
        F.array(feature).alias("features"),
    )
    docs = table(spark, sf, "supplier").select(F.to_json(layer).alias("value"))
    df = features.read_features(spark, land_text(docs, spark, "z"), {"id": "string"}, per_line=True, z=True, m=True)
    moved = shapes.reproject(shapes.simplify("geometry.rings", 0.5, closed=False), 3857, 4326)
    points = F.flatten(shapes.round_points(moved, 6))
    first = F.get(points, F.lit(0))
    return df.select("id", first["x"].alias("lon"), first["y"].alias("lat"), first["z"].alias("z"), first["m"].alias("m"), F.size(points).alias("points"))


@query(
    "conic_there_and_back",
    f"""WITH {SHAPES_SQL} SELECT aid, round(ax / 8 - 125, 6) AS lon, round(ay / 20 + 25, 6) AS lat,
      0.0e0 AS x FROM a""",
)
def _(spark, sf):
    """Longitude and latitude through both conic systems and back; ``x`` is the largest error in metres, rounded."""
    degrees = F.array(F.array(F.struct((F.col("x0") / 8 - 125).alias("x"), (F.col("y0") / 20 + 25).alias("y"))))
    df = areas(spark, sf).select("aid", degrees.alias("d"))
    there = df.withColumn("p", shapes.reproject("d", 4326, 5070))
    lambert = there.withColumn("l", shapes.reproject("p", 5070, 102004))
    back = lambert.withColumn("b", shapes.reproject("l", 102004, 5070)).withColumn("e", shapes.reproject("b", 5070, 4326))
    first = lambda c: F.get(F.get(c, F.lit(0)), F.lit(0))
    off = F.greatest(F.abs(first("b")["x"] - first("p")["x"]), F.abs(first("b")["y"] - first("p")["y"]))
    return back.select("aid", F.round(first("e")["x"], 6).alias("lon"), F.round(first("e")["y"], 6).alias("lat"), F.round(off, 3).alias("x"))


@query(
    "features_read_in_pieces",
    """SELECT s_suppkey::varchar AS "GEOID", s_name || ' {"attributes":{}},{' AS "NAME", 3857 AS srid,
      CASE s_nationkey % 3 WHEN 0 THEN 'MultiPolygon' WHEN 1 THEN 'MultiLineString' ELSE 'Point' END AS kind,
      CASE s_nationkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END AS points, s_suppkey + 0.25e0 AS x FROM supplier""",
)
def _(spark, sf):
    """One layer file per nation; the names hold what separates features."""
    from arealis.sources import pieces
    from arealis.session import scratch_path

    supplier, key, kind = table(spark, sf, "supplier"), F.col("s_suppkey"), F.col("s_nationkey") % 3
    x, y = key + 0.25, key + 0.5
    corners = F.array(F.array(x, y), F.array(x, y + 9), F.array(x + 9, y + 9), F.array(x + 9, y))
    geometry = F.struct(
        F.when(kind == 0, F.array(corners)).alias("rings"),
        F.when(kind == 1, F.array(F.slice(corners, 1, 2))).alias("paths"),
        F.when(kind == 2, x).alias("x"),
        F.when(kind == 2, y).alias("y"),
    )
    name = F.concat("s_name", F.lit(' {"attributes":{}},{'))
    feature = F.struct(F.struct(key.cast("string").alias("GEOID"), name.alias("NAME")).alias("attributes"), geometry.alias("geometry"))
    layers = supplier.groupBy("s_nationkey").agg(F.collect_list(feature).alias("features"))
    names = [F.lit(f"esriGeometry{n}") for n in ("Polygon", "Polyline", "Point")]
    layer = F.struct(
        F.array(*names)[kind.cast("int")].alias("geometryType"),
        F.struct(F.lit(3857).alias("latestWkid")).alias("spatialReference"),
        "features",
    )
    path = scratch_path(spark, "layers")
    layers.select("s_nationkey", F.to_json(layer).alias("value")).write.partitionBy("s_nationkey").text(path)
    df = pieces.read_features(spark, path, {"GEOID": "string", "NAME": "string"})
    points = F.flatten("geometry.rings")
    return df.select(
        "GEOID", "NAME", "srid", "geometry.kind", F.size(points).alias("points"), F.get(points, F.lit(0))["x"].alias("x")
    )


@query(
    "reprojected_and_rounded",
    f"""WITH {SHAPES_SQL} SELECT aid, round(degrees(ax * 1000 / 6378137.0), 6) AS lon,
      round(degrees(2 * atan(exp(ay * 1000 / 6378137.0)) - pi() / 2), 6) AS lat,
      ax + 0.3 AS x_back FROM a""",
)
def _(spark, sf):
    df = areas(spark, sf)
    metres = F.transform(
        "rings",
        lambda r: F.transform(r, lambda p: F.struct((p["x"] * 1000).alias("x"), (p["y"] * 1000).alias("y"))),
    )
    moved = df.withColumn("m", metres).withColumn("ll", shapes.reproject("m", 3857, 4326))
    there = shapes.round_points(shapes.reproject("ll", 4326, 3857), 2)
    first = lambda c: F.get(F.get(c, F.lit(0)), F.lit(0))
    return moved.withColumn("back", there).select(
        "aid",
        F.round(first("ll")["x"], 6).alias("lon"),
        F.round(first("ll")["y"], 6).alias("lat"),
        (first("back")["x"] / 1000 + 0.3).alias("x_back"),
    )


def two_holes(spark, sf):
    """Boxes of the grid with two holes that overlap between 40 and 60."""
    x0, y0 = F.col("x0"), F.col("y0")
    outer = shapes.box_rings(x0, y0, x0 + 100, y0 + 100)
    first = shapes.box_rings(x0 + 20, y0 + 20, x0 + 60, y0 + 60, clockwise=False)
    second = shapes.box_rings(x0 + 40, y0 + 40, x0 + 80, y0 + 80, clockwise=False)
    return grid(spark, sf).withColumn("rings", F.array(first, outer, second))


@query(
    "holes_overlapping",
    f"""WITH {SHAPES_SQL} SELECT aid, oid FROM p WHERE within_box
      AND NOT (ax < x0 + 60 AND ay < y0 + 60 AND ax + w > x0 + 20 AND ay + w > y0 + 20)
      AND NOT (ax < x0 + 80 AND ay < y0 + 80 AND ax + w > x0 + 40 AND ay + w > y0 + 40)""",
)
def _(spark, sf):
    from arealis.operators import rings

    return spatial.relate(areas(spark, sf), rings.with_united_holes(two_holes(spark, sf)), "aid", "oid")


@query(
    "overlapping_holes_assembled",
    """SELECT c_custkey AS fid, 'Polygon with Holes' AS kind, 2 AS rings, (6400 - 2 * 1600 + (40 - 10 - c_custkey % 20) ** 2)::double AS area
    FROM customer""",
)
def _(spark, sf):
    """Per customer a box of side 80 with two holes of side 40, which overlap in a square of side 30 - key % 20."""
    from arealis.operators import rings

    customer, key = table(spark, sf, "customer"), F.col("c_custkey")
    x, y, step = ((key * 37) % 480).cast("double"), ((key * 53) % 470).cast("double"), 10.0 + key % 20

    def pit(at):
        return shapes.box_rings(x + at, y + at, x + at + 40, y + at + 40, clockwise=False)

    shells = F.array(pit(5.0 + step), shapes.box_rings(x, y, x + 80, y + 80), pit(F.lit(5.0)))
    out = rings.assemble(customer.select(key.alias("fid"), shells.alias("rings")), "fid")
    flat = out.withColumn("flat", F.flatten("parts"))
    return flat.select("fid", "kind", F.size("flat").alias("rings"), F.round(shapes.covered_area("flat"), 6).alias("area"))


# --- nine intersections ----------------------------------------------------------------------

MATRIX_SQL = f"""WITH {SHAPES_SQL},
b AS (SELECT aid, oid, ax AS l, ay AS d, ax + w AS r, ay + w AS u, x0, y0, x0 + 100 AS x1, y0 + 100 AS y1 FROM p WHERE meets_box),
c AS (SELECT *, least(r, x1) > greatest(l, x0) AS across, least(u, y1) > greatest(d, y0) AS up,
             l >= x0 AND r <= x1 AND d >= y0 AND u <= y1 AS in_o, x0 >= l AND x1 <= r AND y0 >= d AND y1 <= u AS in_a FROM b),
m AS (SELECT *,
  (up AND ((l < x0 AND x0 < r) OR (l < x1 AND x1 < r))) OR (across AND ((d < y0 AND y0 < u) OR (d < y1 AND y1 < u))) AS ib,
  (up AND ((x0 < l AND l < x1) OR (x0 < r AND r < x1))) OR (across AND ((y0 < d AND d < y1) OR (y0 < u AND u < y1))) AS bi,
  (up AND (l = x0 OR l = x1 OR r = x0 OR r = x1)) OR (across AND (d = y0 OR d = y1 OR u = y0 OR u = y1)) AS shared,
  NOT ((l > x0 AND r < x1 AND d > y0 AND u < y1) OR (x0 > l AND x1 < r AND y0 > d AND y1 < u)) AS touch FROM c),
n AS (SELECT aid, oid, CASE WHEN across AND up THEN '2' ELSE 'F' END || CASE WHEN ib THEN '1' ELSE 'F' END
  || CASE WHEN in_o THEN 'F' ELSE '2' END || CASE WHEN bi THEN '1' ELSE 'F' END
  || CASE WHEN shared THEN '1' WHEN touch THEN '0' ELSE 'F' END || CASE WHEN in_o THEN 'F' ELSE '1' END
  || CASE WHEN in_a THEN 'F' ELSE '2' END || CASE WHEN in_a THEN 'F' ELSE '1' END || '2' AS matrix FROM m)"""


@query("relation_matrix", f"{MATRIX_SQL} SELECT aid, oid, matrix FROM n")
def _(spark, sf):
    return spatial.relation_matrix(areas(spark, sf), boxes(spark, sf), "aid", "oid")


@query("areas_overlapping_boxes", f"{MATRIX_SQL} SELECT aid, oid FROM n WHERE matrix LIKE '2_2___2__'")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), boxes(spark, sf), "aid", "oid", "overlaps")


@query("areas_related_by_pattern", f"{MATRIX_SQL} SELECT aid, oid FROM n WHERE matrix LIKE '2_F_1____'")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), boxes(spark, sf), "aid", "oid", "relation", pattern="T*F*1****")


@query("boxes_around_areas", f"WITH {SHAPES_SQL} SELECT aid, oid FROM p WHERE meets_box")
def _(spark, sf):
    return spatial.relate(areas(spark, sf), triangles(spark, sf), "aid", "oid", "envelope_intersects")


@query(
    "areas_touching_given_shape",
    f"""WITH {SHAPES_SQL} SELECT aid FROM a WHERE ax <= 200 AND ay <= 200 AND ax + w >= 100 AND ay + w >= 100
      AND (ax = 200 OR ay = 200 OR ax + w = 100 OR ay + w = 100)""",
)
def _(spark, sf):
    shape = [[(100, 100), (100, 200), (200, 200), (200, 100)]]
    return spatial.spatial_filter(spark, areas(spark, sf), "aid", shape, "touches").select("aid")
