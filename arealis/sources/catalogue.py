"""Dataset catalogue, variable dictionaries, geography levels, layer lists from landed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


def _list(item: T.DataType = _S) -> T.ArrayType:
    return T.ArrayType(item)


# Fields of a dataset record in the catalogue file.
DATASET = T.StructType(
    [
        T.StructField("@type", _S),
        T.StructField("title", _S),
        T.StructField("description", _S),
        T.StructField("keyword", _list()),
        T.StructField("identifier", _S),
        T.StructField("distribution", _list(_struct("@type", "format", "accessURL", "title"))),
        T.StructField("publisher", _struct("@type", "name")),
        T.StructField("modified", _S),
        T.StructField("spatial", _S),
        T.StructField("temporal", _S),
        T.StructField("c_vintage", T.IntegerType()),
        T.StructField("c_dataset", _list()),
        T.StructField("c_variablesLink", _S),
        T.StructField("c_geographyLink", _S),
        T.StructField("c_tagsLink", _S),
        T.StructField("c_examplesLink", _S),
        T.StructField("c_documentationLink", _S),
    ]
)

# Fields of a variable record.
VARIABLE = _struct(
    "label", "concept", "group", "required", "predicateType", "predicateOnly", "attributes"
)

# Fields of a geography level record.
LEVEL = T.StructType(
    [
        T.StructField("name", _S),
        T.StructField("geoLevelId", _S),
        T.StructField("geoLevelDisplay", _S),
        T.StructField("referenceDate", _S),
        T.StructField("requires", _list()),
        T.StructField("wildcard", _list()),
        T.StructField("optionalWithWCFor", _S),
    ]
)

_FIELD = _struct("name", "type", "alias")
LAYER = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", _S),
        T.StructField("geometryType", _S),
        T.StructField("fields", _list(_FIELD)),
    ]
)


def documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Each file (or each line of it) as one JSON text: ``(path, value)``."""
    files = spark.read.text(path, wholetext=not per_line)  # as an option, the argument would override it
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


# --- catalogue --------------------------------------------------------------------------


def shortcode(identifier: Column | str) -> Column:
    """Text after the last ``id`` of the identifier, without leading slashes."""
    last = F.element_at(F.split(identifier, "id"), -1)
    return F.regexp_replace(last, "^/+", "")


def read_catalogue(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per dataset, nested fields kept, with its ``shortcode``.

    A catalogue landed as JSON lines (``multiline=False``) is split over tasks.
    """
    schema = T.StructType([T.StructField("dataset", _list(DATASET))])
    raw = spark.read.schema(schema).json(path, multiLine=multiline)
    rows = raw.select(F.explode("dataset").alias("d")).select("d.*")
    return rows.withColumn("shortcode", shortcode("identifier"))


def usable(catalogue: DataFrame) -> DataFrame:
    """The brief list: no economic time series, data served by an API."""
    is_api = F.get("distribution", F.lit(0))["format"] == "API"
    return catalogue.where(~F.col("shortcode").contains("eits") & is_api).select("shortcode")


def flatten(catalogue: DataFrame) -> DataFrame:
    """The long list: plain columns in reversed order, by shortcode.

    Columns whose name starts with ``@`` go; a list column whose lists all have one
    element is unnested; the publisher becomes its name; text columns that hold only
    ``http://`` addresses go. Which columns these are is found by one aggregate.
    """
    cols = [c for c in catalogue.columns if not c.startswith("@") and c != "shortcode"]
    kinds = {f.name: f.dataType for f in catalogue.schema.fields}
    lists = [c for c in cols if isinstance(kinds[c], T.ArrayType)]
    texts = [c for c in cols if isinstance(kinds[c], T.StringType)]
    profile = catalogue.agg(
        *[F.min(F.when(F.col(c).isNotNull(), F.size(c))).alias(f"min_{c}") for c in lists],
        *[F.max(F.when(F.col(c).isNotNull(), F.size(c))).alias(f"max_{c}") for c in lists],
        *[
            F.coalesce(F.min(F.col(c).startswith("http://")), F.lit(False)).alias(f"url_{c}")
            for c in texts
        ],
    ).first()
    out = []
    for c in cols:
        if c in lists and profile[f"min_{c}"] == profile[f"max_{c}"] == 1:
            out.append(F.get(c, F.lit(0)).alias(c))
        elif c == "publisher":
            out.append(F.col("publisher.name").alias("publisher"))
        elif c in texts and profile[f"url_{c}"]:
            continue
        else:
            out.append(F.col(c).alias({"identifier": "identifier_url", "c_vintage": "vintage"}.get(c, c)))
    return catalogue.select("shortcode", *reversed(out)).orderBy("shortcode")


def explain_dataset(catalogue: DataFrame, code: str, verbose: bool = False) -> DataFrame:
    row = catalogue.where(F.col("shortcode") == code)
    return row if verbose else row.select("title", "description")


# --- dictionaries ------------------------------------------------------------------------


def _exploded_map(docs: DataFrame, schema: T.DataType, key: str) -> DataFrame:
    parsed = docs.select("path", F.from_json("value", schema).alias("j"))
    return parsed.select("path", F.explode("j").alias(key, "v"))


def parse_variables(docs: DataFrame) -> DataFrame:
    """``{"variables": {name: {…}}}`` -> one row per variable, with the file it came from."""
    schema = T.StructType([T.StructField("variables", T.MapType(_S, VARIABLE))])
    parsed = docs.select("path", F.from_json("value", schema)["variables"].alias("m"))
    return parsed.select("path", F.explode("m").alias("name", "v")).select("path", "name", "v.*")


def parse_geographies(docs: DataFrame) -> DataFrame:
    """``{system: [{…}]}`` -> one row per level with its id system."""
    systems = _exploded_map(docs, T.MapType(_S, _list(LEVEL)), "system")
    return systems.select("path", "system", F.explode("v").alias("l")).select(
        "path", "system", "l.*"
    )


def parse_tags(docs: DataFrame) -> DataFrame:
    """``{key: [tag, …]}`` -> one row per tag; only the first key counts."""
    parsed = F.from_json("value", T.MapType(_S, _list()))
    first = F.get(F.map_values(parsed), F.lit(0))
    return docs.select("path", F.explode(first).alias("tag"))


def parse_examples(docs: DataFrame) -> DataFrame:
    """A JSON array of example entries -> one row per entry, as text."""
    return docs.select("path", F.explode(F.from_json("value", _list())).alias("example"))


# --- map services ----------------------------------------------------------------------------


def parse_services(docs: DataFrame) -> DataFrame:
    """``{"services": [{name, type, description}]}`` -> ``(path, name, type, description)``; the
    name is its part after the last ``/``."""
    item = _struct("name", "type", "description")
    schema = T.StructType([T.StructField("services", _list(item))])
    rows = docs.select("path", F.explode(F.from_json("value", schema)["services"]).alias("s"))
    name = F.element_at(F.split("s.name", "/"), -1).alias("name")
    return rows.select("path", name, "s.type", "s.description")


def parse_layers(docs: DataFrame) -> DataFrame:
    """``{"mapName": …, "layers": [{id, name, geometryType, fields}]}`` -> one row per layer, in file
    order, with the file it came from and its ``service`` (the map name)."""
    schema = T.StructType([T.StructField("mapName", _S), T.StructField("layers", _list(LAYER))])
    parsed = docs.select("path", F.from_json("value", schema).alias("j"))
    layers = parsed.select("path", F.col("j.mapName").alias("service"), F.posexplode("j.layers").alias("position", "l"))
    return layers.select("path", "service", "position", "l.*")


def layer_fields(layers: DataFrame) -> DataFrame:
    """One row per field, with the path, service and number of its layer."""
    rows = layers.select("path", "service", F.col("id").alias("layer"), F.explode("fields").alias("f"))
    return rows.select("path", "service", "layer", "f.*")
