"""Place queries end to end, layer queries."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from arealis.functions import shapes
from arealis.operators import spatial
from arealis.plans.layer_query import Layer, service_layer
from arealis.plans.places import Product
from workload import shapes as ws
from workload.tables import SURVEY_SQL, table, text

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def product(spark, sf) -> Product:
    """Nations are counties and places with a box of the grid, customers are tracts with a
    small box; the estimates are those of the tracts."""
    from workload.tables import survey

    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    states = region.select(
        F.substring("r_name", 1, 2).alias("abbreviation"),
        text("r_regionkey", 2).alias("fips"),
        F.col("r_name").alias("name"),
    )
    boxes = ws.boxes(spark, sf).select("oid", "rings")
    counties = nation.join(boxes, F.col("n_nationkey") == F.col("oid")).select(
        F.concat(text("n_regionkey", 2), text("n_nationkey", 3)).alias("GEOID"),
        F.concat(F.lit("County "), F.col("n_nationkey").cast("string")).alias("BASENAME"),
        text("n_regionkey", 2).alias("STATE"),
        text("n_nationkey", 5).alias("PLACE"),
        F.lit(1).alias("AREALAND"),
        "rings",
    )
    gazetteer = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.substring("r_name", 1, 2).alias("STATE"),
        text("n_regionkey", 2).alias("STATEFP"),
        text("n_nationkey", 5).alias("TARGETFP"),
        F.concat(F.lit("Town "), F.col("n_nationkey").cast("string")).alias("TARGETNAME"),
        F.lit("Incorporated Place").alias("TYPE"),
    )
    subdivision = F.concat(F.lit("Township "), F.col("n_nationkey").cast("string"))
    # county subdivisions have the codes of places, but other outlines: the next box of the grid
    gazetteer = gazetteer.unionByName(
        gazetteer.withColumn("TYPE", F.lit("County Subdivision")).withColumn(
            "TARGETNAME", F.regexp_replace("TARGETNAME", "Town", "Township")
        )
    )
    moved = boxes.select((F.pmod(F.col("oid") - 1, F.lit(25))).alias("oid"), "rings")
    subdivisions = nation.join(moved, F.col("n_nationkey") == F.col("oid")).select(
        F.concat(text("n_regionkey", 2), text("n_nationkey", 3)).alias("GEOID"),
        subdivision.alias("BASENAME"),
        text("n_regionkey", 2).alias("STATE"),
        text("n_nationkey", 5).alias("COUSUB"),
        "rings",
    )
    state_outlines = region.join(boxes, F.col("r_regionkey") == F.col("oid")).select(
        text("r_regionkey", 2).alias("GEOID"),
        F.col("r_name").alias("BASENAME"),
        text("r_regionkey", 2).alias("STATE"),
        (1 + F.col("r_regionkey")).alias("AREALAND"),
        "rings",
    )
    water = counties.withColumn("BASENAME", F.regexp_replace("BASENAME", "County", "Area")).withColumn(
        "AREALAND", F.when(F.col("BASENAME") == "Area 44", 0).otherwise(F.col("AREALAND"))
    )
    small = ws.areas(spark, sf).select("aid", "rings")
    customer = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    tracts = customer.join(small, F.col("c_custkey") == F.col("aid")).select(
        F.concat(text("n_regionkey", 2), text("n_nationkey", 3), text("c_custkey", 10)).alias("GEOID"),
        "rings",
    )
    dictionary = spark.createDataFrame(
        [(n, n, "Balance", n[:4], None, t) for n, t in (("B001_001E", "int"), ("B001_002E", "int"), ("B002_001E", "string"))],
        "name string, label string, concept string, `group` string, required string, predicateType string",
    )
    return Product(
        form="survey",
        dictionary=dictionary,
        estimates=survey(spark, sf),
        outlines={
            "Counties": counties,
            "Incorporated Places": counties,
            "Metropolitan Statistical Areas": counties,
            "Combined Statistical Areas": water,
            "County Subdivisions": subdivisions,
            "States": state_outlines,
        },
        areas={"tract": tracts, "county": counties.select("GEOID", "rings")},
        gazetteer=gazetteer,
        states=states,
    )


def _place_sql(nation, within=True, columns='"B001_001E"'):
    test = (
        "ax >= x0 AND ay >= y0 AND ax + w <= x0 + 100 AND ay + w <= y0 + 100"
        if within
        else "ax <= x0 + 100 AND ay <= y0 + 100 AND ax + w >= x0 AND ay + w >= y0"
    )
    return f"""WITH {SURVEY_SQL}, {ws.SHAPES_SQL},
    hit AS (SELECT a.* FROM a, o WHERE oid = {nation} AND {test}),
    t AS (SELECT lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0')
            || lpad(c_custkey::varchar, 10, '0') AS "GEOID"
          FROM hit JOIN customer ON aid = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    v AS (SELECT split_part("GEO_ID", 'US', 2) AS "GEOID", "NAME", nullif("B001_001E"::double, -666666666) AS "B001_001E",
            "B001_002E"::double AS "B001_002E" FROM survey WHERE level = 'tract')
    SELECT t."GEOID", "NAME", {columns} FROM t LEFT JOIN v ON t."GEOID" = v."GEOID" """


@query("from_place", _place_sql(7, columns='"B001_001E", "B001_002E"'))
def _(spark, sf):
    # NATION_7 lies in the region whose number is 7 % 5
    return product(spark, sf).from_place("town 7, as", ["^B001_"], return_geometry=False)


@query("from_place_shared_code", _place_sql(8))
def _(spark, sf):
    # place and subdivision 7 have one code; the subdivision lies in the next box
    return product(spark, sf).from_place("township 7, as", "B001_001E", return_geometry=False)


@query("from_place_of_type", _place_sql(8))
def _(spark, sf):
    return product(spark, sf).from_place(
        "town 7, as", "B001_001E", place_type="County Subdivision", return_geometry=False
    )


@query("from_state", _place_sql(2))
def _(spark, sf):
    return product(spark, sf).from_state("asia, as", "B001_001E", return_geometry=False)


@query("from_csa", _place_sql(4))
def _(spark, sf):
    return product(spark, sf).from_csa("Area 4", "B001_001E", return_geometry=False)


@query(
    "from_box_counties",
    """SELECT lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0') AS "GEOID", n_name AS "NAME",
      (n_nationkey * 100)::double AS "B001_001E" FROM nation WHERE n_nationkey % 5 <= 2 AND n_nationkey // 5 BETWEEN 1 AND 2""",
)
def _(spark, sf):
    p = dataclasses.replace(product(spark, sf), srid=shapes.LONGITUDE_LATITUDE)
    # boxes of side 100: those of columns 0 to 2 and rows 1 and 2 meet this one
    return p.from_box((50.0, 150.0, 250.0, 250.0), "B001_001E", level="county", return_geometry=False)


@query(
    "decennial_blocks",
    f"""WITH {ws.SHAPES_SQL},
    b AS (SELECT lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0') || lpad(c_custkey::varchar, 10, '0')
        AS "GEOID", c_custkey % 7 AS v FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN p ON aid = c_custkey
      WHERE oid = 12 AND within_box)
    SELECT "GEOID", v::double AS "P001001" FROM b""",
)
def _(spark, sf):
    p = product(spark, sf)
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    ids_ = [text("n_regionkey", 2), text("n_nationkey", 3)]
    estimates = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lit("block").alias("level"),
        ids_[0].alias("state"),
        ids_[1].alias("county"),
        F.concat(F.lit("1000000US"), *ids_, text("c_custkey", 10)).alias("GEO_ID"),
        (F.col("c_custkey") % 7).cast("string").alias("P001001"),
    )
    dictionary = spark.createDataFrame(
        [("P001001", "Total", "Population", "P001", None)],
        "name string, label string, concept string, `group` string, required string",
    )
    blocks = dataclasses.replace(
        p, form="decennial", dictionary=dictionary, estimates=estimates, areas={"block": p.areas["tract"]}
    )
    return blocks.from_county("county 12, as", "^P001", level="block", return_geometry=False)


@query("from_county", _place_sql(12))
def _(spark, sf):
    return product(spark, sf).from_county("county 12, as", "B001_001E", return_geometry=False)


def finely_drawn(rings, steps: int = 750):
    """Four corners, and ``steps`` edges along each side between them."""
    ring = F.get(rings, F.lit(0))

    def side(a, b):
        share = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: i / steps)
        return F.transform(share, lambda t: F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * (b["y"] - a["y"])).alias("y")))

    corners = [F.get(ring, F.lit(i % 4)) for i in range(5)]
    return F.array(F.concat(*(side(a, b) for a, b in zip(corners, corners[1:]))))


@query("from_county_finely_drawn", _place_sql(12))
def _(spark, sf):
    # 3,000 edges: the outline is joined by its edges, not made a constant
    whole = product(spark, sf)
    counties = whole.outlines["Counties"].withColumn("rings", finely_drawn(F.col("rings")))
    fine = dataclasses.replace(whole, outlines={**whole.outlines, "Counties": counties})
    return fine.from_county("county 12, as", "B001_001E", return_geometry=False)


@query("from_statistical_area", _place_sql(19))
def _(spark, sf):
    table_, _ = product(spark, sf).from_msa(
        "County 19", "B001_001E", return_geometry=False, return_bounds=True
    )
    return table_


@query("from_place_bounds", "SELECT '02007' AS \"GEOID\", 200e0 AS xmin, 100e0 AS ymin, 300e0 AS xmax, 200e0 AS ymax")
def _(spark, sf):
    _, outline = product(spark, sf).from_place("Town 7, AS", return_bounds=True)
    return outline.select("GEOID", shapes.bounds("rings").alias("b")).select("GEOID", "b.*")


@query("from_box", _place_sql(13, within=False))
def _(spark, sf):
    box = ws.boxes(spark, sf).where("oid = 13").withColumn("rings", shapes.reproject("rings", 3857, 4326))
    corners = tuple(spatial.total_bounds(box).first())
    # the way to degrees and back may lose the last digit: areas that only touch the box
    # have to be counted, so it is widened by less than any gap between areas
    corners = tuple(v + d for v, d in zip(corners, (-1e-9, -1e-9, 1e-9, 1e-9)))
    return product(spark, sf).from_box(corners, "B001_001E", return_geometry=False)


@query(
    "match_checked",
    """SELECT 'County ' || n_nationkey::varchar || ', ' || substr(r_name, 1, 2) AS "BASENAME",
      lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0') AS "GEOID", 'Counties' AS layer, 100 AS score
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE substr(r_name, 1, 2) = 'AM'""",
)
def _(spark, sf):
    p = product(spark, sf)
    out = p.check_match("County, AM", "counties", return_table=True)
    return out.select("BASENAME", "GEOID", "layer", "score")


# --- layers ---------------------------------------------------------------------------------


def layers(spark, sf):
    customer = table(spark, sf, "customer").join(
        ws.areas(spark, sf).select("aid", "rings"), F.col("c_custkey") == F.col("aid")
    )
    tracts = customer.select(
        F.col("c_custkey").alias("OBJECTID"),
        F.col("c_name").alias("NAME"),
        F.col("c_nationkey").alias("COUNTY"),
        F.col("c_acctbal").alias("AREALAND"),
        F.col("c_mktsegment").alias("KIND"),
        "rings",
    )
    grid = ws.triangles(spark, sf).select(F.col("oid").alias("OBJECTID"), "rings")
    return [Layer(grid, "Counties"), Layer(tracts, "Tracts and Blocks", time="AREALAND")]


@query(
    "layer_rows",
    """SELECT c_custkey AS "OBJECTID", c_name AS "NAME" FROM customer
    WHERE c_acctbal > 0 AND c_nationkey = 3 AND contains(c_name, '1') AND c_acctbal BETWEEN 100 AND 5000""",
)
def _(spark, sf):
    layer = service_layer(layers(spark, sf), "tracts")
    return layer.query(
        where="AREALAND > 0 AND COUNTY = 3",
        text="1",
        time=(100, 5000),
        out_fields="OBJECTID,NAME",
        return_geometry=False,
        order_by=["AREALAND DESC", "OBJECTID"],
    )


@query(
    "layer_statistics",
    """SELECT c_mktsegment AS "KIND", count(c_custkey) AS n, round(sum(c_acctbal), 2) AS total, max(c_nationkey) AS top
    FROM customer WHERE c_acctbal > 0 GROUP BY 1""",
)
def _(spark, sf):
    out = service_layer(layers(spark, sf), 1).query(
        where="AREALAND > 0",
        group_by=["KIND"],
        statistics=[("count", "OBJECTID", "n"), ("sum", "AREALAND", "total"), ("max", "COUNTY", "top")],
        order_by=["KIND"],
    )
    return out.withColumn("total", F.round("total", 2))


@query(
    "layer_count_ids_distinct",
    """SELECT 'count' AS what, count(*)::varchar AS v FROM customer WHERE c_nationkey < 5
    UNION ALL SELECT 'id', c_custkey::varchar FROM customer WHERE c_custkey IN (3, 5, 8)
    UNION ALL SELECT DISTINCT 'kind', c_mktsegment FROM customer""",
)
def _(spark, sf):
    layer = layers(spark, sf)[1]
    count = layer.query(where="COUNTY < 5", return_count_only=True)
    found = layer.query(object_ids=[3, 5, 8], return_ids_only=True)
    kinds = layer.query(out_fields=["KIND"], return_distinct=True)
    named = lambda df, what: df.select(
        F.lit(what).alias("what"), F.col(df.columns[0]).cast("string").alias("v")
    )
    return named(count, "count").unionByName(named(found, "id")).unionByName(named(kinds, "kind"))


@query(
    "layer_in_box_simplified",
    f"""WITH {ws.SHAPES_SQL} SELECT aid AS "OBJECTID", 4 AS points, round(degrees(ax / 6378137.0), 5) AS lon
    FROM a WHERE ax >= 50 AND ay >= 60 AND ax + w <= 400 AND ay + w <= 300""",
)
def _(spark, sf):
    # every box gets a point in the middle of one side, which the simplification drops
    layer = layers(spark, sf)[1]
    ring = F.get("rings", F.lit(0))
    a, b = F.get(ring, F.lit(0)), F.get(ring, F.lit(1))
    middle = F.struct(((a["x"] + b["x"]) / 2 + 0.125).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"))
    longer = F.array(F.concat(F.slice(ring, 1, 1), F.array(middle), F.slice(ring, 2, 3)))
    bent = Layer(layer.df.withColumn("rings", longer), "bent")
    out = bent.query(
        geometry=(50, 60, 400, 300),
        spatial_rel="within",
        out_fields=["OBJECTID"],
        max_allowable_offset=0.25,
        geometry_precision=5,
        out_srid=4326,
    )
    ring = F.get("rings", F.lit(0))
    return out.select("OBJECTID", F.size(ring).alias("points"), F.get(ring, F.lit(0))["x"].alias("lon"))


@query(
    "layer_meeting_shape",
    f"""WITH {ws.SHAPES_SQL} SELECT oid AS "OBJECTID" FROM o
    WHERE x0 <= 260 AND y0 <= 260 AND x0 + 100 >= 130 AND y0 + 100 >= 130
      AND greatest(x0, 130) + greatest(y0, 130) - x0 - y0 <= 100""",
)
def _(spark, sf):
    shape = [[(130, 130), (130, 260), (260, 260), (260, 130)]]
    layer = service_layer(layers(spark, sf), "county")
    return layer.query(geometry=shape, return_ids_only=True)
