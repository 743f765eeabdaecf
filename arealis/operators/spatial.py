"""Spatial filters and joins over shapes given as rings.

A shape table has an id and ``rings array<array<struct<x, y>>>``. No pair of shapes is
looked at unless their boxes meet: boxes are laid on square cells whose side is a power
of two, each box on the level where it covers at most 2 × 2 cells, and joined on the
cell; adaptive execution splits crowded cells. No ring is carried through a join: single
edges of one side meet single edges of the other where they cross the same cell, and cut
each other into pieces. A piece lies wholly inside, outside or on the boundary of the other
shape, which the crossings of a ray from its middle tell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealis.functions import shapes
from arealis.functions.numbers import col
from arealis.session import land

Ring = Sequence[tuple[float, float]]

_LOWEST, _HIGHEST = -20, 60  # cell levels: sides from 2^-20 to 2^60
SALTS = 1  # copies of the smaller side, where splitting at run time is not enough
BANDS = 4  # least number of bands of an outline
SMALL = 5_000  # most shapes and edges of a side that is sent whole to every task

#: Patterns of the nine intersections (interior, boundary and exterior of an area with those of an
#: outline): T not empty, F empty, * either, a digit the dimension. Fixed values.
PATTERNS = {
    "touches": ("FT*******", "F**T*****", "F***T****"),
    "overlaps": ("T*T***T**",),
    "crosses": ("0*T******", "1*T******"),  # of two areas neither can cross the other
    "equals": ("T*F**FFF*",),
}
#: ``relation`` takes a pattern of its own; the envelope tests compare boxes alone.
BY_BOX = ("envelope_intersects", "index_intersects")
RELATIONS = ("intersects", "within", "contains", *PATTERNS, *BY_BOX, "relation")

POINT_BOX = "named_struct('xmin', x, 'ymin', y, 'xmax', x, 'ymax', y)"


def _corners(e: str, wider: str = "0D") -> tuple[str, str, str, str]:
    """Box of an edge, wider by some distance on each side."""
    low = [f"(least({e}.{c}1, {e}.{c}2) - {wider})" for c in "xy"]
    high = [f"(greatest({e}.{c}1, {e}.{c}2) + {wider})" for c in "xy"]
    return (*low, *high)


def _segment_box(e: str, wider: str = "0D") -> str:
    values = ", ".join(f"'{n}', {v}" for n, v in zip(("xmin", "ymin", "xmax", "ymax"), _corners(e, wider)))
    return f"named_struct({values})"


# --- boxes ----------------------------------------------------------------------------------


def total_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Bounding box of all shapes, one row."""
    box = df.select(shapes.bounds(rings).alias("b"))
    return box.agg(
        F.min("b.xmin").alias("xmin"),
        F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"),
        F.max("b.ymax").alias("ymax"),
    )


def with_box(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Box columns next to the geometry; a landed layer that has them prunes by box."""
    box = shapes.bounds(rings)
    return df.withColumn("_b", box).select(*df.columns, "_b.*")


def areas_in_box(
    df: DataFrame,
    box: tuple[float, float, float, float],
    relation: str = "intersects",
    rings: str = "rings",
) -> DataFrame:
    """Shapes that meet a fixed box or lie within it: a filter, no join.

    Where the table has the box columns of :func:`with_box`, their comparison reaches the
    scan.
    """
    xmin, ymin, xmax, ymax = (F.lit(float(v)) for v in box)
    boxed = {"xmin", "ymin", "xmax", "ymax"} <= set(df.columns)
    out = df if boxed else with_box(df, rings)
    if relation == "within":
        near = (
            (F.col("xmin") >= xmin)
            & (F.col("ymin") >= ymin)
            & (F.col("xmax") <= xmax)
            & (F.col("ymax") <= ymax)
        )
        out = out.where(near)
    elif relation == "intersects" or relation in BY_BOX:
        near = (
            (F.col("xmin") <= xmax)
            & (F.col("ymin") <= ymax)
            & (F.col("xmax") >= xmin)
            & (F.col("ymax") >= ymin)
        )
        out = out.where(near)
        if relation == "intersects":
            out = out.where(shapes.rings_meet_box(rings, box))
    else:
        raise ValueError("relation must be 'intersects' or 'within', or go by the box alone")
    return out.select(*df.columns)


# --- pairs of boxes -----------------------------------------------------------------------------


def _level(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    """Lowest level whose cells are at least as long as the box."""
    side = f"greatest({xmax} - {xmin}, {ymax} - {ymin})"
    fit = f"greatest({_LOWEST}, least({_HIGHEST}, cast(ceil(log2({side})) AS int)))"
    return f"if({side} > 0, {fit}, {_LOWEST})"


_LEVEL = _level("box.xmin", "box.ymin", "box.xmax", "box.ymax")


def _cell(value: str, level: str) -> str:
    return f"cast(floor({value} / pow(2D, {level})) AS bigint)"


def _levels_of(df: DataFrame) -> Column:
    """Distinct levels of the boxes (at most a hundred small numbers) as a scalar subquery."""
    return df.agg(F.expr(f"collect_set({_LEVEL})")).scalar()


def _celled(df: DataFrame, others: Column, side: str) -> DataFrame:
    """One row per cell of each box: on its own level, if the other side has boxes that are
    not larger, and on the higher levels of the other side."""
    rest = [c for c in df.columns if c != "box"]
    level, box = f"_k{side}", f"_{side}"
    # corners that cannot be NULL: else the optimizer tests the box, and works it out, twice
    # (a shape without points gets a box, but has no edge or point to pass the exact tests)
    corners = ", ".join(f"'{c}', coalesce(box.{c}, 0D)" for c in ("xmin", "ymin", "xmax", "ymax"))
    solid = df.select(*rest, F.expr(f"named_struct({corners})").alias("box"))
    out = solid.select(
        *rest, F.col("box").alias(box), F.expr(_LEVEL).alias(level), others.alias("_o")
    )
    out = out.selectExpr(
        *rest,
        box,
        level,
        f"""explode(concat(filter(array({level}), k -> array_min(_o) <= k),
                           filter(_o, v -> v > {level}))) AS _k""",
    )
    for axis in ("x", "y"):
        low, high = (_cell(f"{box}.{axis}{end}", "_k") for end in ("min", "max"))
        out = out.selectExpr("*", f"explode(sequence({low}, {high})) AS _c{axis}")
    return out


def _sized(df: DataFrame, small: bool) -> DataFrame:
    """A side of a join, sent whole to the tasks only if its rows were counted.

    The planner goes by the bytes of the files it reads: compressed, and before edges and cells are
    unfolded. Left to itself it sends sides that take a hundred times that through the driver.
    """
    return df.hint("broadcast" if small else "merge")


def box_pairs(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = (),
    salts: int = SALTS,
    points: bool = False,
    right_levels: Column | None = None,
    left_levels: Column | None = None,
    small: str | None = None,
) -> DataFrame:
    """Pairs of rows whose closed boxes meet: ``(*on, left.*, right.*)``, each pair once.

    Both sides have a struct ``box``; other column names must differ but for the keys
    ``on``, which have to be equal. A pair is met on the level of its larger box, in the
    cell that holds the lower left corner of the overlap. The left side should be the
    larger one: it is salted, the right side is copied to each salt. ``points`` tells that
    the left boxes are points, whose level is known without looking; ``left_levels`` and
    ``right_levels`` are those of the boxes, if they are known. ``small`` names a side, ``left`` or
    ``right``, that has at most ``SMALL`` rows.
    """
    # the salt depends on the row alone, so a task that runs again sends it to the same place
    keys = [c for c in left.columns if c != "box"]
    others = _levels_of(right) if right_levels is None else right_levels
    salted = _celled(left, others, "l").withColumn(
        "_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")
    )
    lowest = F.array(F.lit(_LOWEST)) if points else _levels_of(left) if left_levels is None else left_levels
    copied = _celled(right, lowest, "r").selectExpr(
        "*", f"explode(sequence(0, {salts - 1})) AS _salt"
    )
    if small == "left":
        salted = _sized(salted, True)
    else:
        copied = _sized(copied, small == "right")
    joined = salted.join(copied, [*on, "_k", "_cx", "_cy", "_salt"])
    meet = """_l.xmin <= _r.xmax AND _r.xmin <= _l.xmax
        AND _l.ymin <= _r.ymax AND _r.ymin <= _l.ymax"""
    first = f"""_k = greatest(_kl, _kr)
        AND {_cell("greatest(_l.xmin, _r.xmin)", "_k")} = _cx
        AND {_cell("greatest(_l.ymin, _r.ymin)", "_k")} = _cy"""
    kept = [c for c in (*left.columns, *right.columns) if c != "box" and c not in on]
    return joined.where(f"{first} AND {meet}").selectExpr(
        *on, *kept, "_l AS left_box", "_r AS right_box"
    )


# --- points in outlines ---------------------------------------------------------------------------


def _band(y: str, bands: str, box: str) -> str:
    """Number of the horizontal band of an outline that holds a height."""
    share = f"coalesce(try_divide({y} - {box}.ymin, {box}.ymax - {box}.ymin), 0D)"
    return f"greatest(0, least({bands} - 1, cast(floor({share} * {bands}) AS int)))"


def band_count(rings: str) -> Column:
    """Bands of an outline: about the root of the number of its edges."""
    return F.expr(f"cast(greatest({BANDS}, ceil(sqrt(size(flatten({rings}))))) AS int)")


def outline_bands(outlines: DataFrame, ids: Sequence[str], rings: str = "rings") -> DataFrame:
    """Edges of each outline, one row per horizontal band they run through."""
    flat = outlines.select(
        *ids,
        shapes.bounds(rings).alias("_b"),
        band_count(rings).alias("_n"),
        F.explode(shapes.edges(rings)).alias("e"),
    )
    return _banded(flat, ids)


def _banded(edges: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Edges ``e`` of shapes with the box ``_b`` and ``_n`` bands, one row per band."""
    low, high = _band("least(e.y1, e.y2)", "_n", "_b"), _band("greatest(e.y1, e.y2)", "_n", "_b")
    return edges.where("e.y1 <> e.y2").selectExpr(
        *ids, "e", f"explode(sequence({low}, {high})) AS band"
    )


def points_inside(
    pairs: DataFrame,
    outlines: DataFrame,
    ids: Sequence[str],
    rings: str = "rings",
    salts: int = SALTS,
) -> DataFrame:
    """Of the pairs (point, outline) those whose point lies in the outline.

    ``pairs`` has ``ids`` (the outline), ``x``, ``y``, the outline's ``right_box`` and its
    number of ``bands``; further columns name the point. Each pair meets the edges of one
    band of its outline, and the crossings are counted where they are found. An outline
    that holds very many points is spread over its bands and over the salts.
    """
    return points_told(pairs, outline_bands(outlines, ids, rings), ids, salts, "inner").where("inside").drop("inside")


def points_told(
    pairs: DataFrame,
    bands: DataFrame,
    ids: Sequence[str],
    salts: int = SALTS,
    how: str = "left",
    small: bool = False,
) -> DataFrame:
    """The points of ``pairs``, as in :func:`points_inside`, and whether they are ``inside``;
    with ``how`` inner only those that some edge tells about. ``small`` tells that the bands are those
    of at most ``SMALL`` edges."""
    names = [c for c in pairs.columns if c not in ("right_box", "left_box", "bands")]
    keyed = pairs.select(
        *names,
        F.expr(_band("y", "bands", "right_box")).alias("band"),
        F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int").alias("_salt"),
    )
    copied = bands.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    for c in (*ids, "band", "_salt"):
        copied = copied.withColumnRenamed(c, f"_of{c}")
    on = " AND ".join(f"{c} = _of{c}" for c in (*ids, "band", "_salt"))
    met = keyed.join(_sized(copied, small), F.expr(f"{on} AND {shapes.crosses_ray_sql('e', 'x', 'y')}"), how)
    return met.groupBy(*names).agg((F.count("e") % 2 == 1).alias("inside"))


# --- relations of areas and outlines ----------------------------------------------------------------


_IS_POINT = "size(rings) = 1 AND size(get(rings, 0)) = 1"


def _edge_test_sql(relation: str) -> str:
    """Does the segment ``e`` of an outline enter the inside of an area (``rings``, its edges
    ``es``, ``left_box``), or for ``intersects`` meet the area at all?

    The segment is cut where it meets the boundary of the area; it enters the area if
    the middle of a piece lies inside and not on the boundary. It meets the area if it
    enters it or if a cut lies on the boundary. A point, which has no inside, counts as
    entered by a segment that it lies on.
    """
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    ax, ay = "(a.x2 - a.x1)", "(a.y2 - a.y1)"
    wx, wy = "(a.x1 - e.x1)", "(a.y1 - e.y1)"
    det = f"({dx} * {ay} - {dy} * {ax})"
    side = f"({wx} * {dy} - {wy} * {dx})"
    t, u = f"try_divide({wx} * {ay} - {wy} * {ax}, {det})", f"try_divide({side}, {det})"
    crossing = f"if({u} BETWEEN 0 AND 1, {t}, NULL)"
    # a vertex on the segment cuts it too, also where the two run along each other
    length2 = f"({dx} * {dx} + {dy} * {dy})"
    off = f"abs({side}) <= tol * sqrt({length2})"
    vertex = f"if({off}, try_divide({wx} * {dx} + {wy} * {dy}, {length2}), NULL)"
    met = f"flatten(transform(es, a -> array({crossing}, {vertex})))"
    cuts = f"array_sort(array_distinct(concat(array(0D, 1D), filter({met}, c -> c > 0 AND c < 1))))"
    n = "size(cs) - 1"
    middles = f"zip_with(slice(cs, 1, {n}), slice(cs, 2, {n}), (c1, c2) -> (c1 + c2) / 2D)"
    x, y = f"(e.x1 + c * {dx})", f"(e.y1 + c * {dy})"
    near, inside = shapes.on_edges_sql("es", x, y, "tol"), shapes.inside_sql("es", x, y)
    touches = f"exists(cs, c -> {near})"
    if relation == "intersects":
        test = f"({touches} OR exists({middles}, c -> {inside}))"
    else:
        test = f"if({_IS_POINT}, {touches}, exists({middles}, c -> {inside} AND NOT {near}))"
    bind = shapes.bind_sql
    return bind(shapes.tolerance_sql("left_box"), "tol", bind(cuts, "cs", test))


_BOTH = ("_area", "_outline")


def _prepared(df: DataFrame, id_column: str, rings: str, key: str, wider: bool) -> DataFrame:
    """What the joins need of one side, worked out in one pass over its geometry and written.

    ``key`` is the id and the number of the row, so that rows with one id stay apart. ``wider`` tells
    that the boxes of the edges are wider by the tolerance.
    """
    edge = "named_struct('ring', ri, 'i', ei, 'x1', re.x1, 'y1', re.y1, 'x2', re.x2, 'y2', re.y2)"
    edges = f"flatten(transform(rings, (er, ri) -> transform({shapes.ring_edges_sql('er')}, (re, ei) -> {edge})))"
    level = _level(*_corners("e", "tol" if wider else "0D"))
    found = (
        df.select(
            F.struct(F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row")).alias(key),
            col(rings).alias("rings"),
        )
        .select(
            key,
            shapes.bounds("rings").alias("box"),
            shapes.interior_points("rings").alias("ps"),
            F.expr(edges).alias("es"),
            band_count("rings").alias("bands"),
            F.size("rings").alias("n_rings"),
            F.expr(_IS_POINT).alias("lone"),
        )
        .selectExpr("*", f"{shapes.tolerance_sql('box')} AS tol")
        .selectExpr("*", f"array_distinct(transform(es, e -> {level})) AS levels")
    )
    return land(found, key.strip("_")).where("box.xmin IS NOT NULL")


def _is_small(side: DataFrame) -> bool:
    """Has the side, counted where it was written, at most ``SMALL`` shapes and edges?"""
    return (side.agg(F.sum(F.size("es") + 1)).first()[0] or 0) <= SMALL


def _small_side(left_small: bool, right_small: bool) -> str | None:
    """The side that :func:`box_pairs` may send whole."""
    return "right" if right_small else "left" if left_small else None


def _levels(side: DataFrame) -> Column:
    """Distinct levels of the edges' boxes as a scalar subquery."""
    return side.select(F.explode("levels").alias("v")).agg(F.collect_set("v")).scalar()


def _bands_of(side: DataFrame, key: str) -> DataFrame:
    """Edges by band. A single point counts as inside itself: it gets an edge to its right."""
    far = "greatest(1D, abs(box.xmin) * 1e-6D)"
    beside = f"""array(named_struct('ring', 0, 'i', 0, 'x1', box.xmin + {far}, 'y1', box.ymin - {far},
        'x2', box.xmin + {far}, 'y2', box.ymin + {far}))"""
    flat = side.selectExpr(key, "box AS _b", "bands AS _n", f"explode(if(lone, {beside}, es)) AS e")
    return _banded(flat, [key])


def _part_points(
    side: DataFrame, other: DataFrame, key: str, other_key: str, salts: int, smalls: tuple[bool, bool]
) -> DataFrame:
    """Pairs with the number of parts of ``side`` whose inner point lies in the other shape, and of all parts."""
    spots = side.select(
        key, F.expr("inline(transform(ps, (p, i) -> struct(size(ps) AS parts, i AS part, p.x, p.y)))")
    ).withColumn("box", F.expr(POINT_BOX))
    near = box_pairs(
        spots, other.select(other_key, "bands", "box"), salts=salts, points=True, small=_small_side(*smalls)
    )
    told = points_told(near, _bands_of(other, other_key), [other_key], salts, "inner", smalls[1]).where("inside")
    return told.groupBy(*_BOTH).agg(F.count("*").alias("held"), F.max("parts").alias("parts"))


def _contacts(left: DataFrame, right: DataFrame, salts: int, smalls: tuple[bool, bool]) -> DataFrame:
    """Pairs of edges that touch, one of an area (``a``) and one of an outline (``e``).

    ``t`` is where they cross, as a share of ``e``, ``u`` of ``a``. ``a1`` and ``a2`` tell that the ends
    of ``a`` lie on ``e``, at the shares ``ta1`` and ``ta2`` of it; ``e1``, ``e2``, ``ue1`` and ``ue2`` the
    other way round. ``along_e`` tells that ``a`` runs along ``e``, ``along_a`` the reverse.
    """
    ours = left.select("_area", "tol", "lone", F.col("box").alias("area_box"), F.col("bands").alias("area_bands"), F.explode("es").alias("a"))
    theirs = right.select(
        "_outline", F.col("lone").alias("outline_lone"), F.col("box").alias("outline_box"), F.col("bands").alias("outline_bands"), F.explode("es").alias("e")
    )
    met = box_pairs(
        ours.withColumn("box", F.expr(_segment_box("a", "tol"))),
        theirs.withColumn("box", F.expr(_segment_box("e"))),
        salts=salts,
        left_levels=_levels(left),
        right_levels=_levels(right),
        small=_small_side(*smalls),
    )
    steps = (
        ("e.x2 - e.x1 AS dx", "e.y2 - e.y1 AS dy", "a.x2 - a.x1 AS ax", "a.y2 - a.y1 AS ay",
         "a.x1 - e.x1 AS wx", "a.y1 - e.y1 AS wy", "a.x2 - e.x1 AS vx", "a.y2 - e.y1 AS vy",
         "e.x2 - a.x1 AS qx", "e.y2 - a.y1 AS qy"),
        ("sqrt(dx * dx + dy * dy) AS le", "sqrt(ax * ax + ay * ay) AS la", "dx * ay - dy * ax AS det",
         "wx * dy - wy * dx AS off_a1", "vx * dy - vy * dx AS off_a2",
         "wx * ay - wy * ax AS off_e1", "qx * ay - qy * ax AS off_e2"),
        ("try_divide(off_e1, det) AS t", "try_divide(off_a1, det) AS u",
         "try_divide(wx * dx + wy * dy, le * le) AS ta1", "try_divide(vx * dx + vy * dy, le * le) AS ta2",
         "try_divide(-(wx * ax + wy * ay), la * la) AS ue1", "try_divide(qx * ax + qy * ay, la * la) AS ue2",
         "try_divide(tol, le) AS se", "try_divide(tol, la) AS sa"),
        ("if(le > 0, abs(off_a1) <= tol * le AND ta1 BETWEEN -se AND 1 + se, hypot(wx, wy) <= tol) AS a1",
         "if(le > 0, abs(off_a2) <= tol * le AND ta2 BETWEEN -se AND 1 + se, hypot(vx, vy) <= tol) AS a2",
         "if(la > 0, abs(off_e1) <= tol * la AND ue1 BETWEEN -sa AND 1 + sa, hypot(wx, wy) <= tol) AS e1",
         "if(la > 0, abs(off_e2) <= tol * la AND ue2 BETWEEN -sa AND 1 + sa, hypot(qx, qy) <= tol) AS e2",
         "le > 0 AND la > 0 AND abs(off_a1) <= tol * le AND abs(off_a2) <= tol * le AS along_e",
         "le > 0 AND la > 0 AND abs(off_e1) <= tol * la AND abs(off_e2) <= tol * la AS along_a"),
        ("coalesce(t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1, false) AND NOT (a1 OR a2 OR e1 OR e2) AS cross",),
    )
    for step in steps:
        met = met.selectExpr("*", *step)
    # as a filter the test would be pushed below the steps, and repeat them
    touch = met.selectExpr("*", "explode_outer(if(cross OR a1 OR a2 OR e1 OR e2, array(1), NULL)) AS touch")
    return touch.where("touch IS NOT NULL").select(
        *_BOTH, "a", "e", "tol", "lone", "outline_lone", "area_box", "area_bands", "outline_box", "outline_bands",
        "dx", "dy", "ax", "ay", "le", "la", "t", "u", "a1", "a2", "e1", "e2", "ta1", "ta2", "ue1", "ue2",
        "along_e", "along_a", "cross",
    )


def _pieces(touching: DataFrame, vertices: DataFrame, of: str) -> DataFrame:
    """Points that tell where the boundary of one side lies: ``of`` is ``e`` for outlines, ``a`` for areas.

    Edges that touch the other shape are cut where they do; the middle of each piece that doesn't run
    along it is a point. So is a vertex of each ring that touches it nowhere (``vertices``, first points
    of rings in the other's box). All cuts of a ring come together in one sort.
    """
    if of == "e":
        p, dx, dy, length, other = "e", "dx", "dy", "le", "area"
        cross, ends, along = ("cross", "t"), (("a1", "ta1"), ("a2", "ta2")), "along_e"
    else:
        p, dx, dy, length, other = "a", "ax", "ay", "la", "outline"
        cross, ends, along = ("cross", "u"), (("e1", "ue1"), ("e2", "ue2")), "along_a"
    (_, low), (_, high) = ends
    from_, to = f"greatest(least({low}, {high}), 0D)", f"least(greatest({low}, {high}), 1D)"
    event = "named_struct('pos', {}, 'step', {})"
    cuts = [event.format("0D", 0), event.format("1D", 0)]
    for test, at in (cross, *ends):
        cuts.append(f"if({test} AND {at} IS NOT NULL, {event.format(f'greatest(0D, least(1D, {at}))', 0)}, NULL)")
    for at, step in ((from_, 1), (to, -1)):
        cuts.append(f"if({along} AND {from_} < {to}, {event.format(at, step)}, NULL)")
    # a single point is touched, not cut: the point itself stands for what touches it
    alone = "lone" if of == "e" else "outline_lone"
    spot = "a" if of == "e" else "e"
    events = touching.selectExpr(
        *_BOTH, f"{p}.ring AS ring", f"{p}.i AS i", "tol", f"{alone} AS lone",
        f"if({alone}, {spot}.x1, {p}.x1) AS x1", f"if({alone}, {spot}.y1, {p}.y1) AS y1",
        f"if({alone}, 0D, {dx}) AS dx", f"if({alone}, 0D, {dy}) AS dy", f"{length} AS length",
        f"{other}_box AS right_box", f"{other}_bands AS bands",
        f"inline_outer(array({', '.join(cuts)}))",
    ).where("pos IS NOT NULL")
    alone_rows = vertices.selectExpr(
        *_BOTH, "ring", "-1 AS i", "0D AS tol", "false AS lone", "x AS x1", "y AS y1", "0D AS dx", "0D AS dy",
        "0D AS length", "right_box", "bands", "0D AS pos", "0 AS step",
    )
    order = Window.partitionBy(*_BOTH, "ring").orderBy("i", "pos")
    rows = events.unionByName(alone_rows).select(
        "*", F.sum("step").over(order).alias("covers"), F.lead("i").over(order).alias("next"), F.lead("pos").over(order).alias("to")
    )
    piece = "i >= 0 AND next = i AND covers = 0 AND (lone AND pos < to OR (to - pos) * length > 2 * tol)"
    return rows.where(f"(i < 0 AND next IS NULL) OR ({piece})").selectExpr(
        *_BOTH, "ring", "i", "pos", "x1 + if(i < 0, 0D, (pos + to) / 2) * dx AS x",
        "y1 + if(i < 0, 0D, (pos + to) / 2) * dy AS y", "right_box", "bands",
    )


def _ring_vertices(
    side: DataFrame, other: DataFrame, key: str, other_key: str, salts: int, smalls: tuple[bool, bool]
) -> DataFrame:
    """The first point of each ring, with the shapes of the other side whose box holds it."""
    first = "transform(filter(es, e -> e.i = 0), e -> named_struct('ring', e.ring, 'x', e.x1, 'y', e.y1))"
    points = side.selectExpr(key, f"inline({first})").withColumn("box", F.expr(POINT_BOX))
    return box_pairs(
        points, other.select(other_key, "bands", "box"), salts=salts, points=True, small=_small_side(*smalls)
    )


def relate(
    areas: DataFrame,
    outlines: DataFrame,
    area_id: str,
    outline_id: str,
    relation: str = "within",
    area_rings: str = "rings",
    outline_rings: str = "rings",
    salts: int = SALTS,
    pattern: str | None = None,
) -> DataFrame:
    """Pairs ``(area_id, outline_id)`` for which the area stands in the relation to the outline.

    ``within`` counts a shared boundary as within; ``intersects`` counts a shared point;
    ``contains`` is ``within`` the other way round. An area is within an outline exactly
    if a point inside each of its parts is in the outline and no edge of the outline
    enters it: the inside of a part is connected, so it cannot leave the outline without
    meeting an edge. The other relations go by patterns of the nine intersections
    (:func:`relation_matrix`), ``relation`` by the ``pattern`` given; pairs apart from each other are
    in none of them. The envelope relations compare boxes alone.

    The id columns need different names; rows that share an id are shapes of their own. What is
    needed of each side is written when the function is called.
    """
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {RELATIONS}")
    if relation == "contains":
        swapped = relate(
            outlines, areas, outline_id, area_id, "within", outline_rings, area_rings, salts
        )
        return swapped.select(area_id, outline_id)
    if relation in PATTERNS or relation == "relation":
        patterns = PATTERNS.get(relation) or (pattern or "",)
        matrix = relation_matrix(areas, outlines, area_id, outline_id, area_rings, outline_rings, salts)
        return matrix.where(matches("matrix", *patterns)).select(area_id, outline_id)

    left = _prepared(areas, area_id, area_rings, "_area", True)
    right = _prepared(outlines, outline_id, outline_rings, "_outline", False)
    smalls = _is_small(left), _is_small(right)
    if relation in BY_BOX:
        boxes = left.select("_area", "box"), right.select("_outline", "box")
        out = box_pairs(*boxes, salts=salts, small=_small_side(*smalls))
    else:
        contained = _part_points(left, right, "_area", "_outline", salts, smalls)
        touching = _contacts(left, right, salts, smalls)
        vertices = _ring_vertices(right, left, "_outline", "_area", salts, smalls[::-1])
        bands = _bands_of(left, "_area")
        if relation == "within":
            pieces = _pieces(touching, vertices, "e")
            entering = points_told(pieces, bands, ["_area"], salts, "inner", smalls[0]).where("inside")
            out = contained.where("held = parts").join(_sized(entering, False), list(_BOTH), "left_anti")
        else:
            held = points_told(vertices, bands, ["_area"], salts, "inner", smalls[0]).where("inside")
            out = touching.select(*_BOTH).unionByName(contained.select(*_BOTH)).unionByName(held.select(*_BOTH)).distinct()
    return out.select(F.col("_area.id").alias(area_id), F.col("_outline.id").alias(outline_id))


def matches(matrix: str, *patterns: str) -> Column:
    """Does the matrix, nine characters, fit any of the patterns?"""
    letters = {"T": "[012]", "F": "F", "*": ".", "0": "0", "1": "1", "2": "2"}
    for pattern in patterns:
        if len(pattern) != 9 or not set(pattern) <= set(letters):
            raise ValueError(f"a pattern has nine of {''.join(letters)}, not {pattern!r}")
    return F.col(matrix).rlike("^(" + "|".join("".join(letters[c] for c in p) for p in patterns) + ")$")


def relation_matrix(
    areas: DataFrame,
    outlines: DataFrame,
    area_id: str,
    outline_id: str,
    area_rings: str = "rings",
    outline_rings: str = "rings",
    salts: int = SALTS,
) -> DataFrame:
    """``(area_id, outline_id, matrix)`` of the pairs whose boxes meet; all others are apart.

    The matrix has the dimensions of the nine intersections, row by row: interior, boundary and
    exterior of the area with interior, boundary and exterior of the outline; F where there is none.
    Interiors meet if a boundary runs through the other's interior or an inner point of a part lies in
    the other shape; the boundaries' parts inside and outside come from the pieces into which the
    shapes cut each other. A shape of a single point has only an interior.
    """
    left = _prepared(areas, area_id, area_rings, "_area", True)
    right = _prepared(outlines, outline_id, outline_rings, "_outline", False)
    smalls = _is_small(left), _is_small(right)
    touching = land(_contacts(left, right, salts, smalls), "contacts")
    along = "(least(greatest(ta1, ta2), 1D) - greatest(least(ta1, ta2), 0D)) * le > 2 * tol"
    facts = [
        box_pairs(
            left.selectExpr("_area", "box", "n_rings AS area_rings", "size(ps) AS area_parts", "lone AS area_alone"),
            right.selectExpr("_outline", "box", "n_rings AS outline_rings", "size(ps) AS outline_parts", "lone AS outline_alone"),
            salts=salts,
            small=_small_side(*smalls),
        ).drop("left_box", "right_box"),
        touching.groupBy(*_BOTH).agg(
            F.size(F.collect_set("a.ring")).alias("area_touch"),
            F.size(F.collect_set("e.ring")).alias("outline_touch"),
            F.max(F.expr(f"along_e AND {along}")).alias("shared"),
        ),
        _part_points(left, right, "_area", "_outline", salts, smalls).select(*_BOTH, F.col("held").alias("area_held")),
        _part_points(right, left, "_outline", "_area", salts, smalls[::-1]).select(*_BOTH, F.col("held").alias("outline_held")),
    ]
    for of, name, sides, sizes in (
        ("e", "outline", (right, left, "_outline", "_area"), smalls[::-1]),
        ("a", "area", (left, right, "_area", "_outline"), smalls),
    ):
        vertices = _ring_vertices(*sides, salts, sizes)
        bands = _bands_of(sides[1], sides[3])
        told = points_told(_pieces(touching, vertices, of), bands, [sides[3]], salts, small=sizes[1])
        facts.append(
            told.groupBy(*_BOTH).agg(
                F.count_if(F.expr("i < 0 AND inside")).alias(f"{name}_rings_in"),
                F.max(F.expr("i >= 0 AND inside")).alias(f"{name}_in"),
                F.max(F.expr("i >= 0 AND NOT inside")).alias(f"{name}_out"),
            )
        )
    all_ = facts[0]
    for fact in facts[1:]:
        all_ = all_.unionByName(fact, allowMissingColumns=True)
    names = [c for c in all_.columns if c not in _BOTH]
    flags = {f.name for f in all_.schema.fields if f.dataType.simpleString() == "boolean"}
    found = all_.groupBy(*_BOTH).agg(
        *(F.coalesce(F.max(n), F.lit(False) if n in flags else F.lit(0)).alias(n) for n in names)
    )
    return found.where("area_rings > 0").select(
        F.col("_area.id").alias(area_id), F.col("_outline.id").alias(outline_id), F.expr(_MATRIX).alias("matrix")
    )


def _matrix_sql() -> str:
    inner = {  # whether the boundary of one side runs inside and outside the other
        s: (f"({s}_in OR {s}_rings_in > 0)", f"({s}_out OR {s}_rings > {s}_touch + {s}_rings_in)") for s in ("area", "outline")
    }
    (area_in, area_out), (outline_in, outline_out) = inner["area"], inner["outline"]
    meet = f"({area_in} OR {outline_in} OR area_held > 0 OR outline_held > 0)"
    cells = (
        f"if({meet}, '2', 'F')",
        f"if({outline_in}, '1', 'F')",
        f"if({outline_in} OR area_held < area_parts, '2', 'F')",
        f"if({area_in}, '1', 'F')",
        "if(shared, '1', if(area_touch > 0, '0', 'F'))",
        f"if({area_out}, '1', 'F')",
        f"if({area_in} OR outline_held < outline_parts, '2', 'F')",
        f"if({outline_out}, '1', 'F')",
        "'2'",
    )
    touch = "area_touch > 0"
    return f"""CASE
        WHEN area_alone AND outline_alone THEN if({touch}, '0FFFFFFF2', 'FF0FFF0F2')
        WHEN area_alone THEN if({touch}, 'F0FFFF212', if(area_held > 0, '0FFFFF212', 'FF0FFF212'))
        WHEN outline_alone THEN if({touch}, 'FF20F1FF2', if(outline_held > 0, '0F2FF1FF2', 'FF2FF10F2'))
        ELSE concat({', '.join(cells)}) END"""


_MATRIX = _matrix_sql()


def spatial_filter(
    spark: SparkSession,
    df: DataFrame,
    key: str,
    shape: Sequence[Ring],
    relation: str = "intersects",
    rings: str = "rings",
    shape_srid: int | None = None,
    srid: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Rows of a layer that stand in the relation to one given shape (a list of rings).

    The shape is a constant of a filter, but for the relations that go by the nine intersections:
    these join its edges, and ``key`` must tell the rows apart.
    """
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {RELATIONS}")
    points = [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in shape]
    one = spark.createDataFrame(
        [(points,)], "rings array<array<struct<x:double,y:double>>>"
    )
    if shape_srid and srid and shape_srid != srid:
        one = one.withColumn("rings", shapes.reproject("rings", shape_srid, srid))
    known = constant_shapes(one)[0]
    if known["box"] is None or known["box"][0] is None:
        return df.limit(0)
    box = tuple(known["box"])
    if relation in BY_BOX:
        return areas_in_box(df, box, relation, rings)
    if relation in PATTERNS or relation == "relation":
        near = areas_in_box(df, box, BY_BOX[0], rings)
        outline = one.withColumn("_one", F.lit(0))
        pairs = relate(near, outline, key, "_one", relation, rings, "rings", pattern=pattern)
        return near.join(_sized(pairs.select(key).distinct(), False), key, "left_semi")
    near = areas_in_box(df, box, "within" if relation == "within" else "intersects", rings)
    return near.where(stands(relation, rings, known))


def constant_shapes(shapes_: DataFrame, most_edges: int | None = None) -> list:
    """Box, edges and inner points of one shape, brought to the driver to be constants of a filter.

    Two rows where there is more than one shape; no edges where it has more than ``most_edges``.
    """
    few = F.lit(True) if most_edges is None else F.expr("size(flatten(rings))") <= most_edges
    return (
        shapes_.select(
            F.when(few, F.to_json("rings")).alias("rings"),
            F.when(few, F.to_json(shapes.edges("rings"))).alias("edges"),
            F.when(few, F.to_json(shapes.interior_points("rings"))).alias("inner"),
            shapes.bounds("rings").alias("box"),
        )
        .limit(2)
        .collect()
    )


_EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
_POINTS = "array<struct<x:double,y:double>>"


def stands(relation: str, rings: str, shape) -> Column:
    """The relation of an area to one constant shape (see :func:`constant_shapes`), as in :func:`relate`."""
    box = tuple(shape["box"])
    bind = shapes.bind_sql
    edges = f"from_json('{shape['edges']}', '{_EDGES}')"
    inner = f"from_json('{shape['inner']}', '{_POINTS}')"
    corners = ", ".join(f"'{n}', {float(v)!r}D" for n, v in zip(("xmin", "ymin", "xmax", "ymax"), box))
    # names of an area: rings, es (its edges), left_box; of the outline: oe (its edges)
    if relation == "contains":  # the shape lies within the area
        area, area_box = f"from_json('{shape['rings']}', 'array<{_POINTS}>')", f"named_struct({corners})"
        points, outline = inner, shapes.edges_sql(rings)
    else:
        area, area_box = rings, shapes.bounds_sql(rings)
        points, outline = shapes.interior_points_sql(rings), edges
    reaches = shapes.segment_meets_box_sql("e", "left_box", strictly=relation != "intersects")
    if relation != "intersects":
        reaches = f"(left_box.xmin = left_box.xmax OR left_box.ymin = left_box.ymax OR {reaches})"
    test = _edge_test_sql(relation).replace("size(rings)", "size(area)").replace("get(rings, 0)", "get(area, 0)")
    met = f"exists(filter(oes, e -> {reaches}), e -> coalesce({test}, false))"
    held = shapes.inside_sql("oes", "ip.x", "ip.y")
    if relation == "intersects":
        body = f"{met} OR exists(ips, ip -> {held})"
    else:
        body = f"size(ips) > 0 AND forall(ips, ip -> {held}) AND NOT {met}"
    for value, name in ((points, "ips"), (shapes.edges_sql("area"), "es"), (area, "area"), (area_box, "left_box"), (outline, "oes")):
        body = bind(value, name, body)
    return F.expr(body)


def areas_within(
    areas: DataFrame, outlines: DataFrame, area_id: str, outline_id: str, rings: str = "rings"
) -> DataFrame:
    """Areas that lie within any of the outlines, each once."""
    named = outlines.select(F.col(outline_id).alias("_of"), rings)
    hits = relate(areas, named, area_id, "_of", "within", rings, rings)
    return areas.join(_sized(hits.select(area_id), False), area_id, "left_semi")
