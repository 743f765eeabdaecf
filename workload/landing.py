"""Readers and writers: the test tables are landed as files of each format, then read."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import ids
from arealis.operators import moe_replicate as mr
from arealis.plans.table_query import table_query
from arealis.session import scratch_path
from arealis.sources import catalogue as cat
from arealis.sources import codes, landed, rejects, replicates, responses
from arealis.streaming.keyed import KeyedTable, load_keyed
from arealis.streaming.landing import latest, load_new
from workload.tables import (
    DICTIONARY_SQL,
    REPLICATE_ROWS_SQL,
    SURVEY_SQL,
    dictionary,
    replicate_cells,
    survey,
    table,
    text,
)

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def land_text(df, spark, name):
    """One JSON text per line."""
    path = scratch_path(spark, name)
    df.write.text(path)
    return path


# --- catalogue -----------------------------------------------------------------------------


def datasets(spark, sf):
    """A catalogue of the documents: one dataset each, one JSON line each."""
    doc = table(spark, sf, "documents")
    code = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    odd = F.col("doc_id") % 9 == 4
    record = F.struct(
        F.lit("dcat:Dataset").alias("@type"),
        F.concat(F.lit("Set "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.when(odd, F.array("lang", "source")).otherwise(F.array("lang")).alias("keyword"),
        F.concat(F.lit("https://api.example.org/data/id/"), F.when(odd, F.lit("eits/")).otherwise(F.lit("")), code).alias("identifier"),
        F.array(
            F.struct(
                F.when(F.col("doc_id") % 7 == 3, F.lit("PDF")).otherwise(F.lit("API")).alias("format"),
                F.lit("https://api.example.org").alias("accessURL"),
            )
        ).alias("distribution"),
        F.struct(F.lit("Office").alias("name")).alias("publisher"),
        (F.lit(2010) + F.col("doc_id") % 10).cast("int").alias("c_vintage"),
        F.array(F.col("lang")).alias("c_dataset"),
        F.concat(F.lit("http://api.example.org/"), F.col("doc_id").cast("string")).alias("c_variablesLink"),
    )
    return doc.select(F.to_json(F.struct(F.array(record).alias("dataset"))).alias("value"))


SHORTCODE_SQL = """CASE WHEN doc_id % 9 = 4 THEN 'eits/' ELSE '' END
    || source || '/' || lang || '/' || doc_id::varchar"""


@query(
    "catalogue_brief",
    f"""WITH c AS (SELECT *, 'https://api.example.org/data/id/' || {SHORTCODE_SQL} AS i FROM documents)
    SELECT ltrim(string_split(i, 'id')[-1], '/') AS shortcode FROM c
    WHERE NOT contains(ltrim(string_split(i, 'id')[-1], '/'), 'eits') AND doc_id % 7 <> 3""",
)
def _(spark, sf):
    path = land_text(datasets(spark, sf), spark, "catalogue")
    return cat.usable(cat.read_catalogue(spark, path, multiline=False))


@query(
    "catalogue_long",
    f"""WITH c AS (SELECT *, 'https://api.example.org/data/id/' || {SHORTCODE_SQL} AS identifier_url FROM documents)
    SELECT ltrim(string_split(identifier_url, 'id')[-1], '/') AS shortcode, identifier_url,
      'Set ' || doc_id::varchar AS title, text AS description,
      CASE WHEN doc_id % 9 = 4 THEN lang || '|' || source ELSE lang END AS keyword,
      'Office' AS publisher, (2010 + doc_id % 10)::int AS vintage, lang AS c_dataset,
      CASE WHEN doc_id % 7 = 3 THEN 'PDF' ELSE 'API' END AS format FROM c""",
)
def _(spark, sf):
    path = land_text(datasets(spark, sf), spark, "catalogue")
    flat = cat.flatten(cat.read_catalogue(spark, path, multiline=False))
    assert "c_variablesLink" not in flat.columns and "@type" not in flat.columns
    return flat.select(
        "shortcode",
        "identifier_url",
        "title",
        "description",
        F.array_join("keyword", "|").alias("keyword"),
        "publisher",
        "vintage",
        "c_dataset",
        F.col("distribution.format").alias("format"),
    )


@query(
    "catalogue_explained",
    """SELECT 'Set ' || doc_id::varchar AS title, text AS description FROM documents
    WHERE doc_id = (SELECT max(doc_id) FROM documents WHERE doc_id % 9 <> 4)""",
)
def _(spark, sf):
    path = land_text(datasets(spark, sf), spark, "catalogue")
    catalogue = cat.read_catalogue(spark, path, multiline=False)
    # the newest dataset that is no economic series
    code = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    listed = table(spark, sf, "documents").where("doc_id % 9 <> 4")
    newest = listed.agg(F.max_by(code, "doc_id").alias("c")).first()["c"]
    return cat.explain_dataset(catalogue, newest)


# --- dictionaries ---------------------------------------------------------------------------


@query(
    "dictionary_scan",
    f"WITH {DICTIONARY_SQL} SELECT name, label, concept, \"group\", required FROM dictionary",
)
def _(spark, sf):
    # one text per variable; a real file holds all variables of a dataset
    df = dictionary(spark, sf)
    record = F.struct("label", "concept", "group", "required")
    doc = F.to_json(F.struct(F.create_map("name", record).alias("variables")))
    path = land_text(df.select(doc.alias("value")), spark, "variables")
    parsed = cat.parse_variables(cat.documents(spark, path, per_line=True))
    return parsed.select("name", "label", "concept", "group", "required")


@query(
    "geography_levels",
    """SELECT n_name AS system, 'tract' AS name, '140' AS "geoLevelId", 'state|' || r_name AS requires
    FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT n_name, 'county', '050', 'state' FROM nation""",
)
def _(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    df = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    levels = F.array(
        F.struct(
            F.lit("tract").alias("name"),
            F.lit("140").alias("geoLevelId"),
            F.array(F.lit("state"), F.col("r_name")).alias("requires"),
        ),
        F.struct(
            F.lit("county").alias("name"),
            F.lit("050").alias("geoLevelId"),
            F.array(F.lit("state")).alias("requires"),
        ),
    )
    doc = F.to_json(F.create_map("n_name", levels)).alias("value")
    path = land_text(df.select(doc), spark, "geographies")
    parsed = cat.parse_geographies(cat.documents(spark, path, per_line=True))
    return parsed.select("system", "name", "geoLevelId", F.array_join("requires", "|").alias("requires"))


@query(
    "tags_and_examples",
    """SELECT lang AS entry, count(*) AS n FROM documents GROUP BY 1
    UNION ALL SELECT source, count(*) FROM documents GROUP BY 1
    UNION ALL SELECT 'get=' || doc_id::varchar, 1 FROM documents""",
)
def _(spark, sf):
    df = table(spark, sf, "documents")
    tags = F.to_json(F.struct(F.array("lang", "source").alias("tags"))).alias("value")
    entry = F.concat(F.lit("get="), F.col("doc_id").cast("string"))
    examples = F.to_json(F.array(entry)).alias("value")
    tag_docs = cat.documents(spark, land_text(df.select(tags), spark, "tags"), per_line=True)
    example_docs = cat.documents(spark, land_text(df.select(examples), spark, "examples"), per_line=True)
    entries = cat.parse_tags(tag_docs).select(F.col("tag").alias("entry")).unionByName(
        cat.parse_examples(example_docs).select(F.col("example").alias("entry"))
    )
    return entries.groupBy("entry").agg(F.count("*").alias("n"))


@query(
    "map_services_and_layers",
    """SELECT n_name AS service, layer, f AS field, 'string' AS type FROM nation,
      (VALUES (0, 'GEOID'), (0, 'STATE'), (1, 'NAME')) AS t(layer, f)
    WHERE layer = 0 OR n_nationkey % 3 = 1""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation")
    named = lambda *names: F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit("string").alias("type")) for n in names]
    )
    service = F.struct(F.concat(F.lit("maps/"), F.col("n_name")).alias("name"), F.lit("MapServer").alias("type"))
    first = F.struct(F.lit(0).alias("id"), F.lit("Counties").alias("name"), named("GEOID", "STATE").alias("fields"))
    second = F.struct(F.lit(1).alias("id"), F.lit("Tracts").alias("name"), named("NAME").alias("fields"))
    # services differ in their layers
    layers = F.when(F.col("n_nationkey") % 3 == 1, F.array(first, second)).otherwise(F.array(first))
    services = nation.select(F.to_json(F.struct(F.array(service).alias("services"))).alias("value"))
    listed = cat.parse_services(
        cat.documents(spark, land_text(services, spark, "services"), per_line=True)
    )
    one = nation.select(F.to_json(F.struct(layers.alias("layers"), F.col("n_name").alias("mapName"))).alias("value"))
    docs = cat.documents(spark, land_text(one, spark, "layers"), per_line=True)
    fields = cat.layer_fields(cat.parse_layers(docs))
    known = fields.join(listed.select(F.col("name").alias("service")), "service", "left_semi")
    return known.select("service", "layer", F.col("name").alias("field"), "type")


# --- responses -------------------------------------------------------------------------------

RESPONSE_COLUMNS = ["NAME", "B001_001E", "state", "county", "tract"]


def response_texts(df):
    """Responses of at most 500 areas, as a header and rows of strings."""
    number = F.col("tract").cast("long")
    batch = F.floor(number / F.lit(500.0)).cast("long")
    row = F.array(*[F.col(c) for c in RESPONSE_COLUMNS])
    rows = df.groupBy(batch.alias("batch")).agg(F.collect_list(row).alias("rows"))
    header = F.array(F.array(*[F.lit(c) for c in RESPONSE_COLUMNS]))
    return rows.select(F.to_json(F.concat(header, "rows")).alias("value"))


RESPONSE_SQL = f"""WITH {SURVEY_SQL} SELECT "NAME", "B001_001E", state, county, tract
    FROM survey WHERE level = 'tract'"""


@query("responses_read", RESPONSE_SQL)
def _(spark, sf):
    path = land_text(response_texts(survey(spark, sf).where("level = 'tract'")), spark, "responses")
    return responses.read_responses(spark, path, per_line=True)


@query("responses_read_headers_differ", RESPONSE_SQL + " UNION ALL SELECT NULL, \"B001_001E\", state, county, NULL FROM survey WHERE level = 'county'")
def _(spark, sf):
    df = survey(spark, sf)
    texts = response_texts(df.where("level = 'tract'"))
    short = ["B001_001E", "state", "county"]
    rows = df.where("level = 'county'").groupBy("state").agg(F.collect_list(F.array(*short)).alias("rows"))
    header = F.array(F.array(*[F.lit(c) for c in short]))
    other = rows.select(F.to_json(F.concat(header, "rows")).alias("value"))
    path = land_text(texts.unionByName(other), spark, "responses")
    return responses.read_responses(spark, path, per_line=True).select(RESPONSE_COLUMNS)


@query("responses_read_in_lines", RESPONSE_SQL)
def _(spark, sf):
    from arealis.sources import pieces

    texts = response_texts(survey(spark, sf).where("level = 'tract'"))
    # a file per state and text, a row per line
    lines = F.replace(F.col("value"), F.lit("],["), F.lit("],\n["))
    path = scratch_path(spark, "responses")
    numbered = texts.select(F.pmod(F.xxhash64("value"), F.lit(2**31)).alias("part"), lines.alias("value"))
    numbered.write.partitionBy("part").text(path)
    return pieces.read_responses(spark, path, RESPONSE_COLUMNS)


def _drops(spark, sf):
    """The first answers are stale; a later drop corrects every area, the last one repeats some."""
    df = survey(spark, sf).where("level = 'tract'")
    texts = response_texts(df)
    stale = response_texts(df.withColumn("B001_001E", F.lit("0")).withColumn("NAME", F.lit("old")))
    return stale.where(F.length("value") % 2 == 0), texts, texts.where(F.length("value") % 3 == 0)


@query("responses_streamed", RESPONSE_SQL)
def _(spark, sf):
    landing, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "offsets")
    kept = KeyedTable(spark, scratch_path(spark, "keyed"), tuple(RESPONSE_COLUMNS), ("state", "county", "tract"))
    for drop in _drops(spark, sf):
        drop.write.mode("append").text(landing)
        load_keyed(landing, kept, checkpoint, per_line=True).awaitTermination()
    return kept.read()


@query("responses_appended", RESPONSE_SQL)
def _(spark, sf):
    landing, target = scratch_path(spark, "drops"), scratch_path(spark, "target")
    checkpoint = scratch_path(spark, "offsets")
    for drop in _drops(spark, sf):
        drop.write.mode("append").text(landing)
        load_new(spark, landing, target, checkpoint, RESPONSE_COLUMNS, per_line=True).awaitTermination()
    return latest(spark.read.parquet(target), ["state", "county", "tract"])


@query(
    "documents_rejected",
    """SELECT kind, count(*) AS rejected FROM documents,
      (VALUES ('catalogue'), ('variables'), ('geographies'), ('tags'), ('examples'), ('services'), ('layers'),
              ('features'), ('responses')) AS k(kind)
    WHERE doc_id % 4 <> 0 GROUP BY kind""",
)
def _(spark, sf):
    """A good document of each kind beside error answers, pages that are no JSON and empty files."""
    good = {
        "catalogue": '{"dataset": [{"title": "a"}]}',
        "variables": '{"variables": {"A": {"label": "a"}}}',
        "geographies": '{"fips": [{"name": "tract"}]}',
        "tags": '{"tags": ["a"]}',
        "examples": '["a"]',
        "services": '{"services": [{"name": "a"}]}',
        "layers": '{"layers": [{"id": 0}]}',
        "features": '{"geometryType": "esriGeometryPoint", "features": [{"x": 1}]}',
        "responses": '[["NAME"], ["a"]]',
    }
    doc = table(spark, sf, "documents")
    bad = (
        F.when(F.col("doc_id") % 4 == 1, F.to_json(F.struct(F.struct(F.col("text").alias("message")).alias("error"))))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("<html>"), F.regexp_replace("text", "[\\r\\n]", " ")))
        .otherwise(F.lit("{}"))
    )
    out = None
    for kind, text_ in good.items():
        value = F.when(F.col("doc_id") % 4 == 0, F.lit(text_)).otherwise(bad)
        path = land_text(doc.select(value.alias("value")), spark, kind)
        docs = cat.documents(spark, path, per_line=True)
        part = rejects.rejected(docs, kind).select(F.lit(kind).alias("kind"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("kind").agg(F.count("*").alias("rejected"))


@query(
    "landed_table_latest",
    f"""WITH {SURVEY_SQL} SELECT "NAME", "B001_001E", state, county FROM survey
    WHERE level = 'county' AND state = '02'""",
)
def _(spark, sf):
    path = scratch_path(spark, "landed")
    vintages = F.explode(F.array(F.lit(2018), F.lit(2019)))
    old = F.when(F.col("vintage") == 2018, F.lit("0")).otherwise(F.col("B001_001E"))
    df = survey(spark, sf).withColumn("vintage", vintages).withColumn("B001_001E", old)
    landed.write_landed(df, path)
    newest = landed.read_landed(spark, path)
    return table_query(newest, ["NAME", "B001_001E"], "county:*", {"state": "02", "county": "*"}, False)


# --- replicate files ----------------------------------------------------------------------------


def land_replicates(spark, sf):
    """Replicate files of two tables, in directories by year, level and state."""
    df = replicate_cells(spark, sf).withColumns(
        {
            "variable": F.concat(
                F.when(F.col("variable") == "A", F.lit("B01_")).otherwise(F.lit("B02_")),
                F.when(F.col("variable") == "R", F.lit("012")).otherwise(F.lit("003")),
            ),
            "year": F.lit("2015"),
            "level": F.lit("140"),
            "state": text(F.col("geoid").cast("long") % 5, 2),
        }
    )
    # a row without an id, as the files carry for their notes; not a union, which would sum everything twice
    noted = F.when(F.col("geoid") == "1", F.array("geoid", F.lit(None))).otherwise(F.array("geoid"))
    path = scratch_path(spark, "replicates")
    replicates.write_replicates(df.withColumn("geoid", F.explode(noted)), path)
    return path


@query(
    "replicate_files",
    f"""WITH {REPLICATE_ROWS_SQL}, named AS (SELECT geoid, r, est, rep,
      CASE WHEN variable = 'A' THEN 'B01_' ELSE 'B02_' END
        || CASE WHEN variable = 'R' THEN '012' ELSE '003' END AS variable FROM rep_rows)
    SELECT geoid, variable, round(est, 4) AS est,
      round(1.645 * sqrt(4.0e0/80 * sum((rep - est) * (rep - est))), 4) AS moe
    FROM named WHERE variable IN ('B01_003', 'B02_012') GROUP BY geoid, variable, est""",
)
def _(spark, sf):
    root = land_replicates(spark, sf)
    df = replicates.read_replicates(
        spark, f"{root}/year=2015/level=140/table=*/state=*", columns=["B01_003", "B02_012", "B09_001"]
    )
    return df.select("geoid", "variable", F.round("est", 4).alias("est"), F.round("moe", 4).alias("moe"))


@query(
    "replicate_files_of_state",
    f"""WITH {REPLICATE_ROWS_SQL} SELECT geoid, CASE WHEN variable = 'R' THEN 'B02_012' ELSE 'B02_003' END AS variable,
      round(est, 4) AS est, round(1.645 * sqrt(4.0e0/80 * sum((rep - est) * (rep - est))), 4) AS moe
    FROM rep_rows WHERE variable <> 'A' AND geoid::bigint % 5 = 3 GROUP BY geoid, rep_rows.variable, est""",
)
def _(spark, sf):
    root = land_replicates(spark, sf)
    df = replicates.read_replicate_tables(spark, root, ["B02"], 2015, "Tract", "03")
    again = mr.moe_of_arrays(df, ["geoid", "variable"])
    return again.select("geoid", "variable", F.round("est", 4).alias("est"), F.round("moe", 4).alias("moe"))


# --- code and support tables --------------------------------------------------------------------


def _states(spark, sf):
    path = scratch_path(spark, "states")
    region = table(spark, sf, "region").select(
        F.substring("r_name", 1, 3).alias("State Abbreviation"),
        F.col("r_regionkey").cast("string").alias("FIPS Code"),
        F.col("r_name").alias("State Name"),
    )
    region.write.option("header", True).csv(path)
    return codes.read_states(spark, path)


def _places(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    region = table(spark, sf, "region")
    df = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return df.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.substring("r_name", 1, 3).alias("STATE"),
        F.col("r_regionkey").cast("string").alias("STATEFP"),
        F.col("c_custkey").cast("string").alias("PLACEFP"),
        F.concat(F.col("c_name"), F.lit(" Ñ")).alias("PLACENAME"),
        F.col("c_mktsegment").alias("TYPE"),
        F.lit("A").alias("FUNCSTAT"),
        F.col("n_name").alias("COUNTY"),
    )


@query(
    "place_codes_of_state",
    """SELECT substr(r_name, 1, 3) AS "STATE", lpad(r_regionkey::varchar, 2, '0') AS "STATEFP",
      CASE WHEN c_custkey < 10000 THEN lpad(c_custkey::varchar, 5, '0') ELSE c_custkey::varchar END AS "TARGETFP",
      c_name || ' Ñ' AS "TARGETNAME", c_mktsegment AS "TYPE"
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_regionkey = 2""",
)
def _(spark, sf):
    root = scratch_path(spark, "codes")
    writer = _places(spark, sf).write.option("header", True).option("encoding", "ISO-8859-1")
    writer.option("sep", "|").csv(f"{root}/national_places.txt")
    table_ = codes.read_area_codes(spark, root, "place", _states(spark, sf), in_state="2")
    return codes.gazetteer(table_)


@query(
    "county_codes_of_state",
    """SELECT substr(r_name, 1, 3) AS "STATE", n_regionkey::varchar AS "STATEFP", n_nationkey::varchar AS "COUNTYFP",
      n_name AS "COUNTYNAME", 'H1' AS "CLASSFP" FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
)
def _(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    root = scratch_path(spark, "codes")
    df = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.substring("r_name", 1, 3), F.col("n_regionkey"), F.col("n_nationkey"), "n_name", F.lit("H1")
    )
    df.write.csv(f"{root}/national_county.txt")
    return codes.read_area_codes(spark, root, "county", _states(spark, sf), in_state="Asia")


@query(
    "school_district_codes",
    """SELECT substr(r_name, 1, 3) AS c0, n_nationkey::varchar AS c1, n_name AS c2, 'x3' AS c3, 'x4' AS c4, 'x5' AS c5,
      'x6' AS c6, 'x7' AS c7, 'x8' AS c8, 'x9' AS c9, n_regionkey::varchar AS c10
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    root = scratch_path(spark, "codes")
    more = [F.lit(f"x{i}").alias(f"x{i}") for i in range(3, 10)]
    df = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    df = df.select(F.substring("r_name", 1, 3), "n_nationkey", "n_name", *more, "n_regionkey")
    df.write.csv(f"{root}/national_schdist.txt")
    return codes.read_area_codes(spark, root, "School District", _states(spark, sf))


@query(
    "subcounty_and_vtd_codes",
    """SELECT 'SUBCOUNTY' AS kind, substr(r_name, 1, 3) AS "STATE", n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey
      WHERE r_regionkey = 3
    UNION ALL SELECT 'VTD', substr(r_name, 1, 3), n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 3
    UNION ALL SELECT 'AIA', substr(r_name, 1, 3), n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 3
    UNION ALL SELECT 'STATE', substr(r_name, 1, 3), r_name FROM region""",
)
def _(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    root, states = scratch_path(spark, "codes"), _states(spark, sf)
    df = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    abbreviation = F.substring("r_name", 1, 3)
    zero = [F.lit("0").alias(f"z{i}") for i in range(4)]
    df.select(abbreviation, *zero[:2], F.lit("c"), zero[2], "n_name", F.lit("A")).write.csv(f"{root}/national_cousub.txt")
    df.select(abbreviation, "n_name", *zero).write.csv(f"{root}/national_aia.txt")
    vtd = df.select(abbreviation.alias("STATE"), F.col("n_name").alias("VTDNAME"))
    vtd.write.option("header", True).option("sep", "|").csv(f"{root}/national_vtd.txt")
    out = codes.read_area_codes(spark, root, "state", states).select(
        F.lit("STATE").alias("kind"), F.col("abbreviation").alias("STATE"), "name"
    )
    names = {"SUBCOUNTY": ("STATE", "COUSUBNAME"), "VTD": ("STATE", "VTDNAME"), "AIA": ("c0", "c1")}
    for kind, (state, name) in names.items():
        part = codes.read_area_codes(spark, root, kind, states, in_state="3")
        out = out.unionByName(part.select(F.lit(kind).alias("kind"), F.col(state).alias("STATE"), F.col(name).alias("name")))
    return out


@query(
    "support_tables",
    """SELECT '0400000US' || lpad(n_nationkey::varchar, 2, '0') AS geoid, count(c_custkey)::double AS population,
      lpad(n_nationkey::varchar, 2, '0') AS state, (5 + n_nationkey % 12)::double AS avg_weight
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
)
def _(spark, sf):
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    people = nation.join(customer, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    counts = people.groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("B01003_001E"))
    fips = text("n_nationkey", 2)
    pop = counts.select("B01003_001E", F.col("n_name").alias("NAME"), F.concat(F.lit("0400000US"), fips).alias("GEOID"), fips.alias("state"))
    pop_path, weight_path = scratch_path(spark, "pop"), scratch_path(spark, "weights")
    pop.write.option("header", True).csv(pop_path)
    # codes without leading zeros, as one year's file has them
    weights = nation.select(F.col("n_nationkey").alias("fips"), (5 + F.col("n_nationkey") % 12).alias("avg_weight"))
    weights.write.option("header", True).csv(weight_path)
    populations = codes.read_populations(spark, pop_path)
    joined = populations.join(codes.read_weights(spark, weight_path), F.col("state") == F.col("fips"))
    return joined.select("geoid", "population", ids.state_of("geoid").alias("state"), "avg_weight")


@query(
    "rows_rejected",
    """SELECT 'COUNTY' AS kind, count(*) AS rejected, max('AL,' || lpad(c_custkey::varchar, 5, '0') || ',1,name,H1,extra,more') AS last FROM customer WHERE c_custkey % 10 = 3
    UNION ALL SELECT 'SCHOOLDISTRICT', 0, NULL
    UNION ALL SELECT 'POPULATION', count(*), max(lpad(c_custkey::varchar, 5, '0') || 'x,name,1,01') FROM customer WHERE c_custkey % 7 = 2
    UNION ALL SELECT 'WEIGHT', count(*), max('01,' || lpad(c_custkey::varchar, 5, '0') || 'x') FROM customer WHERE c_custkey % 5 = 1""",
)
def _(spark, sf):
    """Every tenth county has two cells too many, some numbers have a letter behind them."""
    key = F.col("c_custkey")
    number = F.lpad(key.cast("string"), 5, "0")
    customer = table(spark, sf, "customer")

    def landed_lines(value, header=None):
        path = scratch_path(spark, "lines")
        text_ = customer.select(value.alias("value"))
        if header:  # each file has one
            head = spark.range(1).select(F.lit(header).alias("value"))
            text_ = head.unionByName(text_.coalesce(1)).coalesce(1)
        text_.write.text(path)
        return path

    root = scratch_path(spark, "codes")
    more = F.when(key % 10 == 3, ",extra,more").otherwise("")
    for file in ("county", "schdist"):
        customer.select(F.concat(F.lit("AL,"), number, F.lit(",1,name,H1"), more).alias("value")).write.text(f"{root}/national_{file}.txt")
    x = lambda n: F.when(key % n[0] == n[1], "x").otherwise("")
    people = landed_lines(F.concat(number, x((7, 2)), F.lit(",name,1,01")), "population,name,geoid,state")
    weights = landed_lines(F.concat(F.lit("01,"), number, x((5, 1))), "fips,avg_weight")
    found = [
        ("COUNTY", codes.rejected_area_codes(spark, root, "county")),
        ("SCHOOLDISTRICT", codes.rejected_area_codes(spark, root, "School District")),
        ("POPULATION", codes.rejected_populations(spark, people)),
        ("WEIGHT", codes.rejected_weights(spark, weights)),
    ]
    parts = [df.agg(F.lit(kind).alias("kind"), F.count("*").alias("rejected"), F.max("line").alias("last")) for kind, df in found]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
