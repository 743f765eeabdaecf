"""Variables of the areas in a place, a county, a state, a statistical area or a box."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions import ids, shapes
from arealis.functions.text import best_name, split_query
from arealis.operators import dictionary as dct
from arealis.operators.names import best_matches, match_table, names_with_state
from arealis.operators.rings import with_united_holes
from arealis.operators.select import replace_missing as drop_codes
from arealis.operators.select import require_columns, to_numbers
from arealis.operators.spatial import areas_in_box, areas_within, constant_shapes, stands, total_bounds

# Place types, and the levels each kind of product offers.
PLACE_TYPES = ("Census Designated Place", "Incorporated Place", "County Subdivision")
LEVELS = {"decennial": ("county", "tract", "block"), "survey": ("county", "tract")}

# Decimals of the coordinates of a layer: centimetres, and as much in degrees.
DECIMALS = {shapes.WEB_MERCATOR: 2, shapes.LONGITUDE_LATITUDE: 7}
LAYER = "layer"
# Up to this many edges of an outline are constants of a filter; more are joined by their position.
MOST_EDGES = 2000
BOX = ("xmin", "ymin", "xmax", "ymax")

Box = tuple[float, float, float, float]


@dataclass(frozen=True)
class Product:
    """The landed tables of one product.

    ``form`` is ``decennial`` or ``survey``. ``dictionary`` lists the variables,
    ``estimates`` holds them (``level``, id columns, ``GEO_ID``, one column each),
    ``outlines`` maps layer names to features (``GEOID``, ``BASENAME``, ``STATE``, ids of
    places, ``rings``) and ``areas`` maps levels to features (``GEOID``, ``rings``), all
    in the reference system ``srid``. ``gazetteer`` lists places, ``states`` state codes.
    """

    form: str
    dictionary: DataFrame
    estimates: DataFrame
    outlines: Mapping[str, DataFrame]
    areas: Mapping[str, DataFrame]
    gazetteer: DataFrame
    states: DataFrame
    srid: int = shapes.WEB_MERCATOR

    # --- dictionary ----------------------------------------------------------------------

    def variables(self) -> DataFrame:
        return self.dictionary.orderBy("name")

    def tables(self) -> DataFrame:
        return dct.table_list(self.dictionary, self.form)

    def crosstab_tables(self) -> DataFrame:
        return dct.table_list(self.dictionary, self.form, crosstabs=True)

    def filter_variables(self, pattern: str, by: str = "name", engine="re") -> DataFrame:
        return dct.search(self.dictionary, pattern, by, engine)

    def filter_tables(self, pattern: str, by: str = "table", engine="re") -> DataFrame:
        return dct.search(self.tables(), pattern, by, engine)

    # --- matching ----------------------------------------------------------------------------

    def layer_name(self, name: str) -> str:
        names = list(self.outlines)
        return names[best_name(names, name)]

    def area_names(self, layer: str) -> DataFrame:
        """Names to match in a layer: ``(BASENAME, GEOID, position)``, land areas only; with
        the state after the name, except for statistical areas, which span states."""
        table = self.outlines[layer]
        if "AREALAND" in table.columns:
            table = table.where("AREALAND > 0")
        if "Statistical" not in layer:
            states = self.states.select(F.col("fips").alias("STATE"), "abbreviation")
            table = names_with_state(table.select("BASENAME", "GEOID", "STATE"), states)
        # a layer lists its areas in the order of their ids
        return table.select("BASENAME", "GEOID", F.col("GEOID").alias("position"))

    def check_match(self, name: str, level: str, return_table: bool = False) -> DataFrame:
        """Best match of a name in the best matching layer: one row with ``layer`` and
        ``GEOID``; or the table of all candidates, worst first."""
        layer = self.layer_name(level)
        candidates = self.area_names(layer)
        if return_table:
            return match_table(candidates, name, "BASENAME").withColumn("layer", F.lit(layer))
        best = best_matches(candidates, name, "BASENAME")
        rows = best.join(candidates.select("position", "GEOID"), "position")
        return rows.withColumn("layer", F.lit(layer))

    def match_place(self, place: str, place_type: str | None = None) -> DataFrame:
        """The gazetteer row that matches ``"name, state"`` best, with its scores."""
        if place_type is not None and place_type not in PLACE_TYPES:
            raise ValueError(f"place_type must be one of {PLACE_TYPES}")
        name, state = split_query(place)
        pool = self.gazetteer
        if place_type is not None:
            pool = pool.where(F.col("TYPE") == place_type)
        if state is not None:
            pool = pool.where(F.lower("STATE") == state)
        # places and county subdivisions of a state share codes; a place is listed once per county
        position = F.concat_ws("/", "STATEFP", "TARGETFP", "TYPE").alias("position")
        columns = self.gazetteer.columns
        once = pool.groupBy(position).agg(F.min(F.struct(*columns)).alias("r")).select("position", "r.*")
        best = best_matches(once, name, "TARGETNAME")
        return best.join(once, "position").select(*columns, "score", "score2", "ambiguous")

    # --- entry points ---------------------------------------------------------------------------

    def from_place(
        self,
        place: str,
        variables: str | Sequence[str] | None = None,
        place_type: str | None = None,
        level: str = "tract",
        **options,
    ):
        """Variables of the areas in a named place. Options as in :meth:`within`."""
        row = self.match_place(place, place_type).first()
        if row is None:
            raise ValueError(f"no place matches {place!r}")
        code = "COUSUB" if row["TYPE"] == "County Subdivision" else "PLACE"
        layer = self.outlines[self.layer_name(row["TYPE"])]
        outline = layer.where((F.col("STATE") == row["STATEFP"]) & (F.col(code) == row["TARGETFP"]))
        return self.within(outline, variables, level, **options)

    def _from_name(self, name, layer, variables, level, **options):
        row = self.check_match(name, layer).first()
        if row is None:
            raise ValueError(f"no area of layer {layer!r} matches {name!r}")
        outline = self.outlines[row["layer"]].where(F.col("GEOID") == row["GEOID"])
        return self.within(outline, variables, level, **options)

    def from_msa(self, msa, variables=None, level="tract", **options):
        return self._from_name(msa, "Metropolitan Statistical Area", variables, level, **options)

    def from_csa(self, csa, variables=None, level="tract", **options):
        return self._from_name(csa, "Combined Statistical Area", variables, level, **options)

    def from_county(self, county, variables=None, level="tract", **options):
        return self._from_name(county, "Counties", variables, level, **options)

    def from_state(self, state, variables=None, level="tract", **options):
        return self._from_name(state, "States", variables, level, **options)

    def from_box(
        self,
        box: Box,
        variables: str | Sequence[str] | None = None,
        level: str = "tract",
        return_geometry: bool = True,
        geometry_precision: int | str | None = LAYER,
        strict_within: bool = False,
        replace_missing: bool = True,
    ) -> DataFrame:
        """Variables of the areas that meet a box in longitude and latitude (or lie within it)."""
        x0, y0, x1, y1 = self._to_layer(box)
        relation = "within" if strict_within else "intersects"
        areas = self._near(level, geometry_precision, (x0, y0, x1, y1), relation)
        return self._with_values(areas, areas, variables, level, return_geometry, replace_missing)

    def within(
        self,
        outline: DataFrame,
        variables: str | Sequence[str] | None = None,
        level: str = "tract",
        return_geometry: bool = True,
        geometry_precision: int | str | None = LAYER,
        strict_within: bool = True,
        return_bounds: bool = False,
        replace_missing: bool = True,
    ):
        """Variables of the areas within given outlines, or that meet their bounding box
        where not ``strict_within``; with ``return_bounds`` also the outlines.

        The outlines' boxes are read first, so that they are a plain filter on the areas. The edges
        of a single outline of moderate size come with its box, and the exact test is a filter too;
        other outlines are joined.
        """
        self._check_level(level)
        decimals = self._decimals(geometry_precision)
        if decimals is not None:
            outline = outline.withColumn("rings", shapes.round_points("rings", decimals))
        outline = with_united_holes(outline)
        known = constant_shapes(outline.select("rings"), MOST_EDGES)
        box = tuple(known[0]["box"]) if len(known) == 1 else tuple(total_bounds(outline).first())
        if box[0] is None:
            raise ValueError("the matched outline is not in the layer")
        near = self._near(level, geometry_precision, box)
        if not strict_within:
            areas = near
        elif len(known) == 1 and known[0]["edges"] is not None:
            areas = near.where(stands("within", "rings", known[0]))
        else:
            areas = areas_within(near, outline, "GEOID", "GEOID")
        table = self._with_values(areas, near, variables, level, return_geometry, replace_missing)
        return (table, outline) if return_bounds else table

    # --- steps -------------------------------------------------------------------------------------

    def _check_level(self, level: str) -> None:
        if level not in LEVELS[self.form]:
            raise ValueError(f"level must be one of {LEVELS[self.form]}")

    def _to_layer(self, box: Box) -> Box:
        """A box in longitude and latitude, in the reference system of the layers."""
        if self.srid == shapes.LONGITUDE_LATITUDE:
            return box
        spark = self.dictionary.sparkSession
        change = shapes.transformer(shapes.LONGITUDE_LATITUDE, self.srid)
        corners = [change(F.lit(float(box[i])), F.lit(float(box[i + 1]))) for i in (0, 2)]
        return tuple(spark.range(1).select(*[v for c in corners for v in c]).first())

    def _decimals(self, precision: int | str | None) -> int | None:
        if precision != LAYER:
            return precision
        shapes.transformer(self.srid, shapes.LONGITUDE_LATITUDE)  # an unknown system raises here, by its number
        return DECIMALS.get(self.srid, 2)  # conic systems are in metres

    def _near(self, level: str, precision: int | str | None, box: Box, relation: str = "intersects") -> DataFrame:
        """Areas that meet a box or lie within it, coordinates rounded.

        Where the landed layer has box columns, a comparison wide enough for the rounding reaches
        the scan before any geometry is read.
        """
        self._check_level(level)
        areas, decimals = self.areas[level], self._decimals(precision)
        if set(BOX) <= set(areas.columns):
            slack = 0.0 if decimals is None else 10.0**-decimals
            x0, y0, x1, y1 = box
            areas = areas.where(
                (F.col("xmin") <= x1 + slack)
                & (F.col("ymin") <= y1 + slack)
                & (F.col("xmax") >= x0 - slack)
                & (F.col("ymax") >= y0 - slack)
            )
        areas = areas.select("GEOID", "rings")
        if decimals is not None:
            areas = areas.withColumn("rings", shapes.round_points("rings", decimals))
        return areas_in_box(areas, box, relation)

    def _with_values(
        self,
        areas: DataFrame,
        near: DataFrame,
        variables,
        level: str,
        return_geometry: bool,
        replace_missing: bool,
    ) -> DataFrame:
        """Areas with their variables; estimates are first reduced to the parents of the areas
        ``near`` (all of them, or more), which prunes the partitions of a landed table."""
        types = {}
        if variables is not None:
            # names of columns: they have to be known to select them
            more = ["predicateType"] if "predicateType" in self.dictionary.columns else []
            found = dct.expand(self.dictionary, variables, *more).collect()
            types = {r["name"]: r["predicateType"] if more else None for r in found}
        names = [n for n in types if n != "GEO_ID"]
        values = self.estimates.where(F.col("level") == level)
        require_columns(values, ["GEO_ID", *names])
        if {"state", "county"} <= set(values.columns):
            parent = ids.parent_id("GEOID", "county")
            parents = near.select(
                F.substring(parent, 1, 2).alias("state"), F.substring(parent, 3, 3).alias("county")
            ).distinct()
            values = values.join(parents, ["state", "county"], "left_semi")
        keep = ["GEO_ID", *(["NAME"] if "NAME" in values.columns else []), *names]
        values = values.select(*dict.fromkeys(keep))
        if replace_missing and names:
            values = drop_codes(to_numbers(values, names, types), names)
        keyed = values.withColumn("GEOID", ids.short_id("GEO_ID")).drop("GEO_ID")
        out = areas.join(keyed, "GEOID", "left")
        return out if return_geometry else out.drop("rings")
