"""Tables, dictionaries, hierarchy, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import ids
from arealis.operators import dictionary as dct
from arealis.operators import hierarchy as hi
from arealis.operators import names, select, shares
from arealis.plans.table_query import table_query
from workload.tables import (
    CELLS_SQL,
    DICTIONARY_SQL,
    SURVEY_SQL,
    cells,
    dictionary,
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


@query(
    "table_query_parents",
    f"""WITH {SURVEY_SQL} SELECT tract, "NAME", "B001_001E"::double AS "B001_001E",
      "B002_001E", state, county
    FROM survey WHERE level = 'tract' AND state = '01' AND county IN ('001', '002', '006')
      AND "B001_002E" = '9'""",
)
def _(spark, sf):
    return table_query(
        survey(spark, sf),
        ["NAME", "B001_001E", "B002_001E"],
        geo_unit="tract:*",
        geo_filter={"state": "01", "county": "001,002,006"},
        index="tract",
        B001_002E="9",
        B002_001E="*",
    )


@query(
    "table_query_units",
    f"""WITH {SURVEY_SQL} SELECT "NAME", "B001_001E", county FROM survey
    WHERE level = 'county' AND county IN ('003', '011', '024')""",
)
def _(spark, sf):
    return table_query(
        survey(spark, sf), ["NAME", "B001_001E"], "county:003,011,024", convert_numeric=False
    )


@query(
    "missing_codes_to_null",
    f"""WITH {SURVEY_SQL} SELECT "GEO_ID", nullif("B001_001E"::double, -666666666) AS "B001_001E",
      "B002_001E" FROM survey""",
)
def _(spark, sf):
    cols = ["B001_001E", "B002_001E"]
    return select.replace_missing(
        select.to_numbers(survey(spark, sf).select("GEO_ID", *cols), cols), cols
    )


@query(
    "column_chunks_joined",
    f"""WITH {SURVEY_SQL} SELECT * EXCLUDE (level) FROM survey WHERE level = 'tract'""",
)
def _(spark, sf):
    df = survey(spark, sf).where("level = 'tract'").drop("level")
    keys = ["state", "county", "tract"]
    rest = [c for c in df.columns if c not in keys]
    chunks = select.column_batches(rest, 2)
    return select.join_chunks([df.select(*keys, *chunk) for chunk in chunks])


@query(
    "id_batches",
    """WITH r AS (SELECT c_nationkey, lpad(c_custkey::varchar, 10, '0') AS tract FROM customer),
    p AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY tract) - 1 AS position,
           count(*) OVER (PARTITION BY c_nationkey) AS n FROM r),
    k AS (SELECT *, ceil(n / 25.0e0)::bigint AS chunks FROM p),
    q AS (SELECT *, n // chunks AS small, n % chunks AS larger FROM k)
    SELECT c_nationkey, tract, position,
      CASE WHEN position < larger * (small + 1) THEN position // (small + 1)
           ELSE larger + (position - larger * (small + 1)) // small END AS batch FROM q""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_nationkey", text("c_custkey", 10).alias("tract"))
    return select.id_batches(df, ["c_nationkey"], "tract", F.substring("tract", 1, 7), most=25)


# --- dictionary --------------------------------------------------------------------------


@query(
    "variables_like_regex",
    f"WITH {DICTIONARY_SQL} SELECT name, label FROM dictionary WHERE regexp_matches(label, '^(red|small) .*t$')",
)
def _(spark, sf):
    return dct.search(dictionary(spark, sf), "^(red|small) .*t$", by="label").select("name", "label")


@query(
    "variables_like_glob",
    f"WITH {DICTIONARY_SQL} SELECT name, required FROM dictionary WHERE name GLOB 'B0001[0-4]*_*7E' AND required IS NOT NULL",
)
def _(spark, sf):
    required = dct.required_predicates(dictionary(spark, sf))
    return dct.search(required, "B0001[0-4]*_*7E", engine="fnmatch").select("name", "required")


@query(
    "variables_like_function",
    f"WITH {DICTIONARY_SQL} SELECT name, label FROM dictionary WHERE ends_with(name, '5E')",
)
def _(spark, sf):
    ends = lambda candidate, pattern: candidate.endswith(pattern)
    return dct.search(dictionary(spark, sf), "5E", engine=ends).select("name", "label")


@query(
    "variables_expanded",
    f"""WITH {DICTIONARY_SQL} SELECT DISTINCT name FROM dictionary
    WHERE regexp_matches(name, '^B0000[12]_') OR regexp_matches(name, '03E$')""",
)
def _(spark, sf):
    return dct.expand(dictionary(spark, sf), ["^B0000[12]_", "03E$"])


@query(
    "variables_explained",
    f"""WITH {DICTIONARY_SQL} SELECT name, label, concept FROM dictionary
    WHERE name IN ('B00003_000000001E', 'B00012_000000000E', 'none')""",
)
def _(spark, sf):
    return dct.explain_variables(
        dictionary(spark, sf), ["B00003_000000001E", "B00012_000000000E", "none"]
    )


def single_concepts(spark, sf):
    """The dictionary as a survey has it: one concept per table."""
    return dictionary(spark, sf).withColumn("concept", F.regexp_replace("concept", " b$", ""))


SINGLE_SQL = """single AS (SELECT "group" AS "table", min(regexp_replace(concept, ' b$', '')) AS description,
      count(*) AS n_columns FROM dictionary GROUP BY 1)"""

TABLE_LIST_SQL = """SELECT "group" AS "table", min(concept) AS description, count(*) AS n_columns
    FROM dictionary GROUP BY 1 HAVING count(DISTINCT concept) = 1"""


@query(
    "main_tables_by_group",
    f"WITH {DICTIONARY_SQL}, t AS ({TABLE_LIST_SQL}) SELECT * FROM t WHERE regexp_matches(\"table\", '[0-9]$')",
)
def _(spark, sf):
    return dct.table_list(dictionary(spark, sf), "decennial")


@query(
    "crosstabs_by_stem",
    f"WITH {DICTIONARY_SQL}, {SINGLE_SQL} SELECT * FROM single WHERE NOT regexp_matches(\"table\", '[0-9]$')",
)
def _(spark, sf):
    return dct.table_list(single_concepts(spark, sf), "survey", crosstabs=True)


@query(
    "table_columns",
    f"""WITH {DICTIONARY_SQL}, t AS ({TABLE_LIST_SQL}) SELECT "group" AS "table", name AS "column"
    FROM dictionary WHERE "group" IN (SELECT "table" FROM t) AND regexp_matches("group", '[0-9]$')""",
)
def _(spark, sf):
    return dct.table_columns(dictionary(spark, sf), "decennial")


@query(
    "tables_filtered",
    f"WITH {DICTIONARY_SQL}, {SINGLE_SQL} SELECT * FROM single WHERE regexp_matches(\"table\", '[0-9]$') AND regexp_matches(description, '[123]0?$')",
)
def _(spark, sf):
    return dct.search(dct.table_list(single_concepts(spark, sf), "survey"), "[123]0?$", by="description")


# --- hierarchy ---------------------------------------------------------------------------------


def areas(spark, sf):
    """Tracts and blocks with nested ids: customers and their orders."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    orders = table(spark, sf, "orders")
    tracts = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.concat(
            text(F.col("n_regionkey") * 15 + 1, 2), text("n_nationkey", 3), text("c_custkey", 6)
        ).alias("geoid"),
    )
    blocks = orders.join(tracts, F.col("o_custkey") == F.col("c_custkey")).select(
        F.lit("block").alias("level"), F.concat("geoid", text("o_orderkey", 8)).alias("geoid")
    )
    return tracts.select(F.lit("tract").alias("level"), "geoid").unionByName(blocks)


AREAS_SQL = """
tracts AS (SELECT c_custkey, lpad((n_regionkey * 15 + 1)::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0')
             || lpad(c_custkey::varchar, 6, '0') AS geoid
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
blocks AS (SELECT geoid || lpad(o_orderkey::varchar, 8, '0') AS geoid
           FROM orders JOIN tracts ON o_custkey = c_custkey)"""


@query(
    "blocks_of_county",
    f"WITH {AREAS_SQL} SELECT 'block' AS level, geoid FROM blocks WHERE geoid LIKE '16006%'",
)
def _(spark, sf):
    return hi.areas_below(areas(spark, sf), "block", state="16", county="6")


@query(
    "blocks_of_the_states",
    f"WITH {AREAS_SQL} SELECT 'block' AS level, geoid FROM blocks WHERE substr(geoid, 1, 2)::int < 60",
)
def _(spark, sf):
    return hi.national(areas(spark, sf), "block")


@query(
    "hierarchy_walk",
    """SELECT o_orderkey AS block, c_custkey AS tract, c_nationkey AS county FROM orders
    JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0
      AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""",
)
def _(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    pair = [F.col("c_nationkey").alias("county"), F.col("c_custkey").alias("tract")]
    tracts = customer.where("c_acctbal > 0").select(*pair)
    owners = customer.select(*pair)
    blocks = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("block"), F.col("o_custkey").alias("tract")
    ).join(owners, "tract")
    counties = nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("county"))
    return hi.walk(blocks, [(tracts, ["county", "tract"]), (counties, ["county"])])


@query("tracts_per_county", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _(spark, sf):
    return hi.ids_per_parent(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment")


@query(
    "id_functions",
    """SELECT '1400000US' || lpad(c_nationkey::varchar, 2, '0') || lpad(c_custkey::varchar, 9, '0') AS long_id,
      lpad(c_nationkey::varchar, 2, '0') || lpad(c_custkey::varchar, 9, '0') AS geoid,
      lpad(c_nationkey::varchar, 2, '0') AS state, 'tract' AS kind, '140' AS code,
      CASE WHEN c_custkey < 100 THEN lpad(c_custkey::varchar, 3, '0') ELSE c_custkey::varchar END AS padded FROM customer""",
)
def _(spark, sf):
    long_id = F.concat(F.lit("1400000US"), text("c_nationkey", 2), text("c_custkey", 9))
    df = table(spark, sf, "customer").withColumn("long_id", long_id)
    return df.select(
        "long_id",
        ids.short_id("long_id").alias("geoid"),
        ids.state_of("long_id").alias("state"),
        ids.level_type_column(ids.level_code_of("long_id")).alias("kind"),
        ids.level_code_column(F.lit("Tract")).alias("code"),
        ids.pad_left("c_custkey", 3).alias("padded"),
    )


# --- joins ------------------------------------------------------------------------------------


@query(
    "areas_with_values",
    f"""WITH {SURVEY_SQL} SELECT c_custkey, "GEOID", "B001_001E" FROM (
      SELECT c_custkey, lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0')
        || lpad(c_custkey::varchar, 10, '0') AS "GEOID" FROM customer JOIN nation ON c_nationkey = n_nationkey)
    LEFT JOIN (SELECT split_part("GEO_ID", 'US', 2) AS "GEOID", "B001_001E" FROM survey
      WHERE "B002_001E" <> 'MACHINERY') USING ("GEOID")""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation")
    outlines = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    geoid = F.concat(text("n_regionkey", 2), text("n_nationkey", 3), text("c_custkey", 10))
    values = survey(spark, sf).where("B002_001E <> 'MACHINERY'")
    values = values.select(ids.short_id("GEO_ID").alias("GEOID"), "B001_001E")
    return select.attach_values(outlines.select("c_custkey", geoid.alias("GEOID")), values)


@query(
    "names_with_state",
    """SELECT c_name || coalesce(', ' || CASE WHEN r_regionkey < 4 THEN substr(r_name, 1, 2) END, '') AS "BASENAME",
      lpad(n_regionkey::varchar, 2, '0') AS "STATE"
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation")
    df = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    df = df.select(F.col("c_name").alias("BASENAME"), text("n_regionkey", 2).alias("STATE"))
    states = table(spark, sf, "region").where("r_regionkey < 4").select(
        text("r_regionkey", 2).alias("STATE"), F.substring("r_name", 1, 2).alias("abbreviation")
    )
    return names.names_with_state(df, states).select("BASENAME", "STATE")


@query(
    "merge_on_different_keys",
    """SELECT o_orderkey AS place_l, o_custkey AS state, c_custkey AS "STATEFP", c_nationkey AS "PLACE_r"
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, sf):
    left = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("place"), F.col("o_custkey").alias("state")
    )
    right = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("STATEFP"), F.col("c_nationkey").alias("PLACE")
    )
    return select.merge(left, right, ["state"], ["STATEFP"], suffixes=("_l", "_r"))


VINTAGES_SQL = """
v AS (SELECT o_custkey AS geoid, year(o_orderdate) AS y,
             sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS part, sum(o_totalprice) AS total
      FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1, 2)"""


def _vintage(spark, sf, year):
    orders = table(spark, sf, "orders").where(F.year("o_orderdate") == year)
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)
    sums = orders.groupBy(F.col("o_custkey").alias("geoid")).agg(
        F.sum(done).alias("part"), F.sum("o_totalprice").alias("total")
    )
    return shares.with_share(sums, "share", "part", "total").select("geoid", "share")


@query(
    "change_between_vintages",
    f"""WITH {VINTAGES_SQL}, b AS (SELECT a.geoid, a.part / a.total AS old, b.part / b.total AS new
      FROM v a JOIN v b ON a.geoid = b.geoid AND a.y = 1996 AND b.y = 1997)
    SELECT geoid, round(old, 6) AS share_1996, round(new, 6) AS share_1997,
      CASE WHEN old = 0 AND new = 0 THEN NULL WHEN old = 0 THEN 999 ELSE round((new - old) / old, 6) END AS pct_change
    FROM b""",
)
def _(spark, sf):
    out = shares.change(
        _vintage(spark, sf, 1997), _vintage(spark, sf, 1996), "share", "geoid", ("_1997", "_1996")
    )
    infinite = F.col("pct_change") == F.lit(float("inf"))
    return out.select(
        "geoid",
        F.round("share_1996", 6).alias("share_1996"),
        F.round("share_1997", 6).alias("share_1997"),
        F.when(infinite, F.lit(999.0)).otherwise(F.round("pct_change", 6)).alias("pct_change"),
    )


@query(
    "share_of_group",
    """WITH s AS (SELECT l_suppkey AS geoid, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS a,
      sum(l_quantity) AS t FROM lineitem GROUP BY 1) SELECT geoid, a, t, round(a / t, 6) AS share FROM s WHERE t > 1000""",
)
def _(spark, sf):
    line = table(spark, sf, "lineitem")
    sums = line.groupBy(F.col("l_suppkey").alias("geoid")).agg(
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0.0)).alias("a"),
        F.sum("l_quantity").alias("t"),
    )
    return shares.with_share(sums.where("t > 1000"), "share", "a", "t").withColumn(
        "share", F.round("share", 6)
    )


@query(
    "dissimilarity",
    """WITH s AS (SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS g,
      sum(l_quantity) AS t FROM lineitem GROUP BY 1)
    SELECT round(0.5 * sum(abs(g / (SELECT sum(g) FROM s) - (t - g) / (SELECT sum(t - g) FROM s))), 9) AS dissimilarity FROM s""",
)
def _(spark, sf):
    line = table(spark, sf, "lineitem")
    sums = line.groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0.0)).alias("g"),
        F.sum("l_quantity").alias("t"),
    )
    return shares.dissimilarity(sums, "g", "t").select(F.round("dissimilarity", 9).alias("dissimilarity"))


# --- requested versus present --------------------------------------------------------------


@query(
    "requested_areas_in_order",
    f"""WITH {CELLS_SQL} SELECT c_custkey::varchar AS geoid, (c_custkey * 7) % 1000003 AS position, round(est, 6) AS est
    FROM customer LEFT JOIN (SELECT geoid, est FROM cells WHERE variable = 'A') c ON geoid = c_custkey::varchar""",
)
def _(spark, sf):
    # customers ask for the suppliers of the same number; most of them are not there
    key = F.col("c_custkey")
    wanted = table(spark, sf, "customer").select(
        key.cast("string").alias("geoid"), ((key * 7) % 1000003).alias("position")
    )
    data = cells(spark, sf).where("variable = 'A'").select("geoid", F.round("est", 6).alias("est"))
    return select.as_requested(wanted, data).orderBy("position")


@query(
    "areas_without_data",
    """SELECT c_custkey AS geoid FROM customer WHERE c_custkey NOT IN (
      SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')""",
)
def _(spark, sf):
    wanted = table(spark, sf, "customer").select(F.col("c_custkey").alias("geoid"))
    found = table(spark, sf, "orders").where("o_orderpriority = '5-LOW'")
    return select.absent(wanted, found.select(F.col("o_custkey").alias("geoid")))


@query(
    "areas_with_data",
    """SELECT c_custkey AS geoid FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def _(spark, sf):
    wanted = table(spark, sf, "customer").select(F.col("c_custkey").alias("geoid"))
    found = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    return select.present(wanted, found.select(F.col("o_custkey").alias("geoid")))


@query(
    "frames_stacked",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return select.stack([customer, supplier])


# --- names -----------------------------------------------------------------------------------


def gazetteer(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat_ws(", ", "c_name", "n_name").alias("target"), F.col("c_custkey").alias("position")
    )


def _lookups(spark, sf):
    """One name per nation: its last customer, in capitals and without the first letters.

    What is left of the name is contained in one candidate only, so that the best match
    is certain (a name that merely resembles its candidate may tie with others).
    """
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    last = customer.groupBy("c_nationkey").agg(F.max("c_name").alias("c_name"))
    rows = last.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.upper(F.substring("c_name", 4, 100)), F.lit(" , "), F.lower("n_name")).alias("q")
    )
    return sorted(r["q"] for r in rows.collect())  # one row per nation


@query(
    "names_best_match",
    """WITH l AS (SELECT c_nationkey, max(c_name) AS c_name FROM customer GROUP BY 1)
    SELECT upper(substr(l.c_name, 4)) || ' , ' || lower(n_name) AS query,
      l.c_name || ', ' || n_name AS target, c_custkey AS position, 100 AS score,
      round_even(200e0 * (length(l.c_name) - 3) / (length(l.c_name) - 3 + length(l.c_name || ', ' || n_name)), 0)::int AS score2,
      false AS ambiguous
    FROM l JOIN nation ON c_nationkey = n_nationkey JOIN customer USING (c_name)""",
)
def _(spark, sf):
    return names.best_matches(gazetteer(spark, sf), _lookups(spark, sf))


@query(
    "names_ambiguous",
    """SELECT q AS query, c_mktsegment AS target, min(c_custkey) AS position, 100 AS score,
      round_even(200e0 * length(q) / (length(q) + length(c_mktsegment)), 0)::int AS score2, count(*) > 1 AS ambiguous
    FROM customer JOIN (VALUES ('auto'), ('build'), ('mach'), ('furniture'), ('house')) AS t(q)
      ON contains(lower(c_mktsegment), q) GROUP BY q, c_mktsegment""",
)
def _(spark, sf):
    # many candidates of one name: the position decides, and says so
    segments = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("target"), F.col("c_custkey").alias("position")
    )
    return names.best_matches(segments, ["auto", "build", "mach", "furniture", "house"])


@query(
    "names_resembling",
    """SELECT q AS query, c_mktsegment AS target, min(c_custkey) AS position, score, score2, count(*) > 1 AS ambiguous
    FROM customer JOIN (VALUES ('automobike', 'AUTOMOBILE', 90, 90), ('bilding', 'BUILDING', 86, 93), ('machinary', 'MACHINERY', 89, 89),
      ('furnitur shop', 'FURNITURE', 89, 73)) AS t(q, c_mktsegment, score, score2)
      USING (c_mktsegment) GROUP BY q, c_mktsegment, score, score2""",
)
def _(spark, sf):
    # matched letters: automobi + e; b + ilding, in the window uilding ilding; machin + ry; furnitur
    segments = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("target"), F.col("c_custkey").alias("position")
    )
    return names.best_matches(segments, ["automobike", "bilding", "machinary", "furnitur shop"])


@query(
    "names_from_index",
    """WITH l AS (SELECT c_nationkey, max(c_name) AS c_name FROM customer GROUP BY 1)
    SELECT upper(substr(l.c_name, 4)) || ' , ' || lower(n_name) AS query,
      l.c_name || ', ' || n_name AS target, c_custkey AS position, 100 AS score, false AS ambiguous
    FROM l JOIN nation ON c_nationkey = n_nationkey JOIN customer USING (c_name)""",
)
def _(spark, sf):
    index = names.NameIndex.build(gazetteer(spark, sf))
    return names.best_matches(index, _lookups(spark, sf)).drop("score2")


@query(
    "names_match_table",
    """SELECT c_name || ', ' || n_name AS target, c_custkey AS position, 100 AS score,
      (CASE WHEN c_name IS NULL THEN 0 ELSE round_even(2000e0 / (10 + length(c_name || ', ' || n_name)), 0) END)::int AS score2
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name LIKE '%\\_7' ESCAPE '\\'""",
)
def _(spark, sf):
    # "customer#0" is contained in every candidate, so both scores follow from lengths
    return names.match_table(gazetteer(spark, sf), "Customer#0, _7")
