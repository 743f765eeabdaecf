"""Expressions over rings: ``array<array<struct<x, y>>>``, all inside the row.

Outer rings run clockwise, holes counter-clockwise. Whether a ring repeats its first
point at the end does not matter.

Names that end in ``_sql`` give SQL text and take SQL text (a column name, a lambda
variable, any expression): nested lambdas read better that way, and the plan is built in
one step. The others give Columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from arealis.functions.conic import SYSTEMS, Conic
from arealis.functions.numbers import col

# Fixed value: radius of the sphere of web mercator (EPSG:3857), in metres.
EARTH_RADIUS = 6378137.0
LONGITUDE_LATITUDE, WEB_MERCATOR = 4326, 3857


def bind_sql(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to the value, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


# --- edges and areas ----------------------------------------------------------------------


def ring_edges_sql(ring: str) -> str:
    """Consecutive points of a ring as ``struct(x1, y1, x2, y2)``, the closing edge included."""
    ahead = f"concat(slice({ring}, 2, greatest(size({ring}) - 1, 0)), slice({ring}, 1, 1))"
    edge = "named_struct('x1', pa.x, 'y1', pa.y, 'x2', pb.x, 'y2', pb.y)"
    return f"zip_with({ring}, {ahead}, (pa, pb) -> {edge})"


def edges_sql(rings: str) -> str:
    return f"flatten(transform({rings}, er -> {ring_edges_sql('er')}))"


def signed_area_sql(ring: str) -> str:
    """Shoelace sum, positive for a counter-clockwise ring. Taken relative to the first
    point, so that large coordinates do not swallow small shapes."""
    step = "(ae.x1 - p0.x) * (ae.y2 - p0.y) - (ae.x2 - p0.x) * (ae.y1 - p0.y)"
    total = f"aggregate({ring_edges_sql(ring)}, 0D, (acc, ae) -> acc + {step}) / 2D"
    return bind_sql(f"get({ring}, 0)", "p0", total)


def is_clockwise_sql(ring: str) -> str:
    return f"({signed_area_sql(ring)} < 0)"


def shells_sql(rings: str) -> str:
    """The clockwise rings; all rings where none is clockwise."""
    outer = f"filter({rings}, sr -> {is_clockwise_sql('sr')})"
    chosen = bind_sql(outer, "so", f"if(size(so) > 0, so, {rings})")
    return f"if(size({rings}) = 1, {rings}, {chosen})"


def edges(rings: str) -> Column:
    return F.expr(edges_sql(rings))


def ring_turns(rings: str) -> Column:
    """For each ring, whether it is clockwise."""
    return F.expr(f"transform({rings}, tr -> {is_clockwise_sql('tr')})")


def covered_area(rings: str) -> Column:
    """Area of the outer rings less that of the holes."""
    return F.expr(f"aggregate({rings}, 0D, (ca, cr) -> ca - {signed_area_sql('cr')})")


# Names of the kinds of polygons.
MIXED = "MultiPolygon with Holes"


def kind_of(n: Column, outer: Column) -> Column:
    """Kind of a polygon with ``n`` rings, ``outer`` of them clockwise."""
    return (
        F.when(n <= 1, "Polygon")
        .when(outer == 1, "Polygon with Holes")
        .when((outer == n) | (outer == 0), "MultiPolygon")
        .otherwise(MIXED)
    )


# --- boxes -----------------------------------------------------------------------------------


def bounds(rings: str) -> Column:
    return F.expr(bounds_sql(rings))


def bounds_sql(rings: str) -> str:
    body = """named_struct(
        'xmin', array_min(transform(ps, p -> p.x)), 'ymin', array_min(transform(ps, p -> p.y)),
        'xmax', array_max(transform(ps, p -> p.x)), 'ymax', array_max(transform(ps, p -> p.y)))"""
    return bind_sql(f"flatten({rings})", "ps", body)


def box_text(box: Column) -> Column:
    return F.format_string("%.6f,%.6f,%.6f,%.6f", box["xmin"], box["ymin"], box["xmax"], box["ymax"])


def box_rings(xmin: Column, ymin: Column, xmax: Column, ymax: Column, clockwise=True) -> Column:
    """The ring of a box."""
    corners = [(xmin, ymin), (xmin, ymax), (xmax, ymax), (xmax, ymin)]
    if not clockwise:
        corners.reverse()
    points = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners]
    return F.array(*points)


# --- points ------------------------------------------------------------------------------------


def _each_point(rings: Column | str, change) -> Column:
    return F.transform(col(rings), lambda ring: F.transform(ring, change))


def round_points(rings: Column | str, digits: int) -> Column:
    """Positions rounded; heights and measures stay as they are."""
    return _each_point(
        rings, lambda p: p.withField("x", F.round(p["x"], digits)).withField("y", F.round(p["y"], digits))
    )


def to_longitude_latitude(x: Column, y: Column) -> tuple[Column, Column]:
    lon = F.degrees(x / EARTH_RADIUS)
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(y / EARTH_RADIUS)) - F.lit(math.pi / 2))
    return lon, lat


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    x = F.radians(lon) * EARTH_RADIUS
    y = F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2.0)) * EARTH_RADIUS
    return x, y


def _to_degrees(system: int | Conic) -> Callable[[Column, Column], tuple[Column, Column]]:
    if system == LONGITUDE_LATITUDE:
        return lambda x, y: (x, y)
    return to_longitude_latitude if system == WEB_MERCATOR else _conic(system).inverse


def _from_degrees(system: int | Conic) -> Callable[[Column, Column], tuple[Column, Column]]:
    if system == LONGITUDE_LATITUDE:
        return lambda lon, lat: (lon, lat)
    return to_web_mercator if system == WEB_MERCATOR else _conic(system).forward


def _conic(system: int | Conic) -> Conic:
    known = system if isinstance(system, Conic) else SYSTEMS.get(system)
    if known is None:
        raise ValueError(f"no closed form for EPSG:{system}; a Conic can be given in its place")
    return known


def transformer(source: int | Conic, target: int | Conic):
    """Point transformation between longitude and latitude, web mercator and conic systems.

    A system is a number or a :class:`Conic` of its own parameters. Datums are taken as one.
    """
    if source == target:
        return lambda x, y: (x, y)
    there, on = _to_degrees(source), _from_degrees(target)
    return lambda x, y: on(*there(x, y))


def reproject(rings: Column | str, source: int | Conic, target: int | Conic) -> Column:
    """Points in another reference system; what else they have stays as it is."""
    change = transformer(source, target)

    def moved(p: Column) -> Column:
        x, y = change(p["x"], p["y"])
        return p.withField("x", x).withField("y", y)

    return _each_point(rings, moved)


# --- position of points and segments -----------------------------------------------------------


def crosses_ray_sql(e: str, x: str, y: str) -> str:
    """Does the edge meet the ray from the point to the right? Ends count half-open, so
    that a vertex on the ray is met once."""
    spans = f"({e}.y1 > {y}) <> ({e}.y2 > {y})"
    at = f"{e}.x1 + try_divide(({y} - {e}.y1) * ({e}.x2 - {e}.x1), {e}.y2 - {e}.y1)"
    return f"if({spans}, {x} < {at}, false)"


def inside_sql(edge_list: str, x: str, y: str) -> str:
    """Even-odd rule over the edges of all rings."""
    return f"(size(filter({edge_list}, ie -> {crosses_ray_sql('ie', x, y)})) % 2 = 1)"


def on_edges_sql(edge_list: str, x: str, y: str, tolerance: str) -> str:
    """Is the point within the tolerance of any edge?"""
    along = (
        f"try_divide(({x} - oe.x1) * (oe.x2 - oe.x1) + ({y} - oe.y1) * (oe.y2 - oe.y1), "
        "pow(oe.x2 - oe.x1, 2) + pow(oe.y2 - oe.y1, 2))"
    )
    t = f"greatest(0D, least(1D, coalesce({along}, 0D)))"
    distance = f"hypot({x} - (oe.x1 + ot * (oe.x2 - oe.x1)), {y} - (oe.y1 + ot * (oe.y2 - oe.y1)))"
    return f"exists({edge_list}, oe -> {bind_sql(t, 'ot', distance)} <= {tolerance})"


def segment_meets_box_sql(e: str, box: str, strictly: bool = False) -> str:
    """Does the closed segment meet the closed box, or ``strictly`` its inside (by clipping it)?"""
    less = "<" if strictly else "<="
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    xa, xb = (f"try_divide({box}.{side} - {e}.x1, {dx})" for side in ("xmin", "xmax"))
    ya, yb = (f"try_divide({box}.{side} - {e}.y1, {dy})" for side in ("ymin", "ymax"))
    # least and greatest skip the NULLs of a segment parallel to an axis
    start = f"greatest(0D, least({xa}, {xb}), least({ya}, {yb}))"
    stop = f"least(1D, greatest({xa}, {xb}), greatest({ya}, {yb}))"
    in_x = f"({dx} <> 0 OR ({box}.xmin {less} {e}.x1 AND {e}.x1 {less} {box}.xmax))"
    in_y = f"({dy} <> 0 OR ({box}.ymin {less} {e}.y1 AND {e}.y1 {less} {box}.ymax))"
    return f"({in_x} AND {in_y} AND {start} {less} {stop})"


def rings_meet_box(rings: str, box: tuple[float, float, float, float]) -> Column:
    """Does the closed shape meet the closed box?"""
    values = ", ".join(
        f"'{n}', {float(v)!r}D" for n, v in zip(("xmin", "ymin", "xmax", "ymax"), box)
    )
    meets = f"exists(bes, be -> {segment_meets_box_sql('be', 'bx')})"
    holds = inside_sql("bes", "bx.xmin", "bx.ymin")
    test = bind_sql(f"named_struct({values})", "bx", f"({meets} OR {holds})")
    return F.expr(bind_sql(edges_sql(rings), "bes", test))


def tolerance_sql(box: str) -> str:
    """Distance below which two positions count as one, for coordinates of this size."""
    return (
        f"greatest(abs({box}.xmin), abs({box}.ymin), abs({box}.xmax), abs({box}.ymax), 1D) * 1e-12D"
    )


def interior_points(rings: str) -> Column:
    return F.expr(interior_points_sql(rings))


def interior_points_sql(rings: str) -> str:
    """One point strictly inside each part of a shape: ``array<struct<x, y>>``.

    The point lies on a horizontal line through the widest gap between the heights of
    the vertices, where no vertex is met, halfway from the leftmost meeting with the
    part's outer ring to the next meeting with any ring. For each part only the rings
    whose box meets the box of its outer ring are looked at. A shape of a single point
    gives that point.
    """

    def meetings(edge_list: str) -> str:
        at = "me.x1 + try_divide((py - me.y1) * (me.x2 - me.x1), me.y2 - me.y1)"
        met = f"filter({edge_list}, me -> (me.y1 > py) <> (me.y2 > py))"
        return f"transform({met}, me -> {at})"

    def box(ring: str) -> str:
        sides = ", ".join(
            f"'{end}{axis}', array_{end}(transform({ring}, p -> p.{axis}))"
            for axis in ("x", "y")
            for end in ("min", "max")
        )
        return f"named_struct({sides})"

    meet = """b.box.minx <= sb.maxx AND b.box.maxx >= sb.minx
        AND b.box.miny <= sb.maxy AND b.box.maxy >= sb.miny"""
    near = f"flatten(transform(filter(rb, b -> {meet}), b -> {ring_edges_sql('b.ring')}))"
    near = f"if(size(rb) = 1, {ring_edges_sql('sh')}, {near})"
    # heights of the vertices between the lowest and the highest point of the part
    own = "array_sort(array_distinct(filter(transform(es, e -> e.y1), h -> h BETWEEN sb.miny AND sb.maxy)))"
    gap = "(lo, hi) -> named_struct('gap', hi - lo, 'y', (lo + hi) / 2D)"
    gaps = f"zip_with(ho, slice(ho, 2, greatest(size(ho) - 1, 0)), {gap})"
    height = bind_sql(own, "ho", f"array_max({gaps}).y")
    right = f"array_min(filter({meetings('es')}, m -> m > lx))"
    halfway = f"named_struct('x', (lx + {right}) / 2D, 'y', py)"
    left = f"array_min({meetings(ring_edges_sql('sh'))})"
    point = bind_sql(height, "py", bind_sql(left, "lx", halfway))
    point = bind_sql(box("sh"), "sb", bind_sql(near, "es", point))
    points = f"filter(transform({shells_sql(rings)}, sh -> {point}), q -> q.x IS NOT NULL)"
    ring_box = f"if(size({rings}) = 1, NULL, {box('r')})"  # a single ring needs no search
    boxed = f"transform({rings}, r -> named_struct('ring', r, 'box', {ring_box}))"
    found = bind_sql(boxed, "rb", points)
    first = f"get(get({rings}, 0), 0)"
    alone = f"array(named_struct('x', {first}.x, 'y', {first}.y))"
    return f"if(size({rings}) = 1 AND size(get({rings}, 0)) = 1, {alone}, {found})"


# --- simplification -------------------------------------------------------------------------------


def _kept(x: np.ndarray, y: np.ndarray, offset: float) -> np.ndarray:
    """Points of one line that stay when no dropped point may lie farther than ``offset``
    from the line through its kept neighbours."""
    keep = np.zeros(len(x), dtype=bool)
    keep[[0, -1]] = True
    spans = [(0, len(x) - 1)]
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        dx, dy = x[b] - x[a], y[b] - y[a]
        length = math.hypot(dx, dy)
        distance = np.abs(px * dy - py * dx) / length if length > 0 else np.hypot(px, py)
        far = int(distance.argmax())
        if distance[far] > offset:
            keep[a + 1 + far] = True
            spans += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def simplify(rings: Column | str, offset: float, closed: bool = True) -> Column:
    """Drop points that lie within ``offset`` of the simplified line.

    A closed ring keeps at least three points, its first one among them.
    """

    def of_ring(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
        if len(x) < 3:
            return np.ones(len(x), dtype=bool)
        if not closed:
            return _kept(x, y, offset)
        keep = _kept(np.append(x, x[0]), np.append(y, y[0]), offset)[:-1]
        if keep.sum() < 3:  # the ring would collapse: keep its farthest points
            far = int(np.hypot(x - x[0], y - y[0]).argmax())
            off = np.abs((x - x[0]) * (y[far] - y[0]) - (y - y[0]) * (x[far] - x[0]))
            keep[[0, far, int(off.argmax())]] = True
        return keep

    @F.pandas_udf("array<array<boolean>>")
    def masks(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series(
            [[of_ring(x, y) for x, y in zip(rx, ry)] for rx, ry in zip(xs, ys)], dtype=object
        )

    rings = col(rings)
    xs = F.transform(rings, lambda r: F.transform(r, lambda p: p["x"]))
    ys = F.transform(rings, lambda r: F.transform(r, lambda p: p["y"]))
    return F.zip_with(
        rings,
        masks(xs, ys),
        lambda ring, mask: F.filter(ring, lambda p, i: F.get(mask, i)),
    )
