"""Inputs of the checked queries, derived from the test tables by arithmetic.

Roles: region = state, nation = county, customer and supplier = tract, orders = block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str | Column, width: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(c.cast("string"), width, "0")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates with margins: one row per supplier and return flag."""
    line = table(spark, sf_dir, "lineitem")
    hit = (F.col("l_discount") >= 0.1) & (F.col("l_quantity") > 45)
    return line.groupBy(
        F.col("l_suppkey").cast("string").alias("geoid"), F.col("l_returnflag").alias("variable")
    ).agg(
        F.sum(F.when(hit, F.col("l_quantity")).otherwise(0.0)).alias("est"),
        F.round(1.645 * F.sqrt(F.sum(F.col("l_tax") * F.col("l_quantity"))), 6).alias("moe"),
    )


CELLS_SQL = """
cells AS (
  SELECT l_suppkey::varchar AS geoid, l_returnflag AS variable,
         sum(CASE WHEN l_discount >= 0.1 AND l_quantity > 45 THEN l_quantity ELSE 0 END) AS est,
         round(1.645 * sqrt(sum(l_tax * l_quantity)), 6) AS moe
  FROM lineitem GROUP BY 1, 2)"""


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numerators inside denominators, with margins, per brand; per brand also a share of
    one with equal margins and a zero denominator."""
    part = table(spark, sf_dir, "part")
    size = F.sqrt(F.sum(F.col("p_size").cast("double")))
    main = part.groupBy(F.col("p_brand").alias("geoid")).agg(
        F.sum(F.when(F.col("p_size") >= 48, F.col("p_retailprice")).otherwise(0.0)).alias("n"),
        F.sum("p_retailprice").alias("d"),
        size.alias("m1"),
        (15 * size).alias("m2"),
    )
    kinds = F.explode(F.array(F.lit("part"), F.lit("whole"), F.lit("empty")))
    kind = F.col("kind")
    return main.withColumn("kind", kinds).select(
        F.concat_ws("/", "geoid", "kind").alias("geoid"),
        F.when(kind == "whole", F.col("d")).otherwise(F.col("n")).alias("n"),
        F.when(kind == "empty", F.lit(0.0)).otherwise(F.col("d")).alias("d"),
        F.when(kind == "whole", F.col("m2")).otherwise(F.col("m1")).alias("m1"),
        "m2",
    )


SHARES_SQL = """
main AS (
  SELECT p_brand AS geoid,
         sum(CASE WHEN p_size >= 48 THEN p_retailprice ELSE 0 END) AS n,
         sum(p_retailprice) AS d,
         sqrt(sum(p_size * 1.0e0)) AS m1, 15 * sqrt(sum(p_size * 1.0e0)) AS m2
  FROM part GROUP BY p_brand),
shares AS (
  SELECT geoid || '/part' AS geoid, n, d, m1, m2 FROM main
  UNION ALL SELECT geoid || '/whole', d, d, m2, m2 FROM main
  UNION ALL SELECT geoid || '/empty', n, 0e0, m1, m2 FROM main)"""


def replicate_lines(spark: SparkSession, sf_dir: str, *keys: Column) -> DataFrame:
    """Keys, ``est`` and 80 replicates of the quantity of line items.

    The weight of a replicate depends on the variance class of a line item (97 classes),
    so the quantities are summed by key and class before they are weighted.
    """
    line = table(spark, sf_dir, "lineitem")
    mix = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 97
    classes = line.groupBy(*keys, mix.cast("int").alias("class")).agg(
        F.sum("l_quantity").alias("est")
    )
    names = [c for c in classes.columns if c not in ("class", "est")]
    return classes.select(*names, "est", F.expr(f"{weighted_replicates()} AS reps"))


def weighted_replicates() -> str:
    """``est`` times the 80 weights of its ``class``.

    The weights of the classes from 0 on are runs of one constant array, as 7 * 14 = 1 modulo 97: so only the
    products are worked out in each row. Others (negative keys, none) take the formula itself.
    """
    formula = "transform(sequence(1, 80), r -> est * (1.5D - ((class + r * 7) % 97) % 2))"
    weights = ", ".join(f"{1.5 - 7 * i % 97 % 2}D" for i in range(97 + 80))
    run = f"transform(slice(array({weights}), class * 14 % 97 + 2, 80), w -> est * w)"
    return f"if(class >= 0, {run}, {formula})"


def replicate_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long replicate table: supplier × return flag, with margin and standard error."""
    from arealis.operators import moe_replicate as mr

    lines = replicate_lines(
        spark,
        sf_dir,
        (F.col("l_suppkey").cast("string")).alias("geoid"),
        F.col("l_returnflag").alias("variable"),
    )
    sums = mr.collapse(lines, ["geoid", "variable"])
    with_moe = sums.withColumn("moe", mr.replicate_moe(F.col("est"), F.col("reps")))
    return with_moe.select(
        "geoid", "variable", "est", "moe", (F.col("moe") / 1.645).alias("se"), "reps"
    )


REPLICATE_ROWS_SQL = """
rep_rows AS (
  SELECT l_suppkey::varchar AS geoid, l_returnflag AS variable, r, sum(l_quantity) AS est,
         sum(l_quantity * (CASE WHEN ((l_orderkey*31 + l_linenumber*17 + r*7) % 97) % 2 = 0
                                THEN 1.5 ELSE 0.5 END)) AS rep
  FROM lineitem, range(1, 81) AS t(r) GROUP BY 1, 2, 3)"""


# --- areas with variables -----------------------------------------------------------------


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area estimates as text, tracts and counties: codes for missing values included."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    county = nation.select(
        F.col("n_nationkey").alias("k"),
        text("n_regionkey", 2).alias("state"),
        text("n_nationkey", 3).alias("county"),
        F.col("n_name").alias("county_name"),
    )
    whole = F.round(F.col("c_acctbal")).cast("long")
    tracts = customer.join(county, F.col("c_nationkey") == F.col("k")).select(
        F.lit("tract").alias("level"),
        "state",
        "county",
        text("c_custkey", 10).alias("tract"),
        F.concat(F.lit("1400000US"), "state", "county", text("c_custkey", 10)).alias("GEO_ID"),
        F.concat_ws(", ", "c_name", "county_name").alias("NAME"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit("-666666666"))
        .otherwise(whole.cast("string"))
        .alias("B001_001E"),
        F.length("c_mktsegment").cast("string").alias("B001_002E"),
        F.col("c_mktsegment").alias("B002_001E"),
    )
    counties = county.select(
        F.lit("county").alias("level"),
        "state",
        "county",
        F.lit(None).cast("string").alias("tract"),
        F.concat(F.lit("0500000US"), "state", "county").alias("GEO_ID"),
        F.col("county_name").alias("NAME"),
        (F.col("k") * 100).cast("string").alias("B001_001E"),
        F.col("k").cast("string").alias("B001_002E"),
        F.lit("county").alias("B002_001E"),
    )
    return tracts.unionByName(counties)


SURVEY_SQL = """
survey AS (
  SELECT 'tract' AS level, lpad(n_regionkey::varchar, 2, '0') AS state,
         lpad(n_nationkey::varchar, 3, '0') AS county, lpad(c_custkey::varchar, 10, '0') AS tract,
         '1400000US' || lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0')
           || lpad(c_custkey::varchar, 10, '0') AS "GEO_ID",
         c_name || ', ' || n_name AS "NAME",
         CASE WHEN c_custkey % 11 = 0 THEN '-666666666' ELSE round(c_acctbal)::bigint::varchar END AS "B001_001E",
         length(c_mktsegment)::varchar AS "B001_002E", c_mktsegment AS "B002_001E"
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'county', lpad(n_regionkey::varchar, 2, '0'), lpad(n_nationkey::varchar, 3, '0'), NULL,
         '0500000US' || lpad(n_regionkey::varchar, 2, '0') || lpad(n_nationkey::varchar, 3, '0'),
         n_name, (n_nationkey * 100)::varchar, n_nationkey::varchar, 'county'
  FROM nation)"""


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable dictionary; every fifth table is a crosstab, table 3 has two concepts."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    number = key % 40
    stem = F.concat(
        F.lit("B"), text(number, 5), F.when(number % 5 == 4, F.lit("A")).otherwise(F.lit(""))
    )
    order = F.floor(key / F.lit(40.0)).cast("long")
    second = (number == 3) & (order % 2 == 1)
    return part.select(
        F.concat(stem, F.lit("_"), text(order, 9), F.lit("E")).alias("name"),
        F.col("p_name").alias("label"),
        F.concat(F.lit("Topic "), number.cast("string"), F.when(second, F.lit(" b")).otherwise(F.lit(""))).alias(
            "concept"
        ),
        stem.alias("group"),
        F.when(F.col("p_size") == 1, F.lit("true")).alias("required"),
    )


DICTIONARY_SQL = """
parts AS (SELECT *, p_partkey % 40 AS num, floor(p_partkey / 40.0e0)::bigint AS ord FROM part),
dictionary AS (
  SELECT 'B' || lpad(num::varchar, 5, '0') || CASE WHEN num % 5 = 4 THEN 'A' ELSE '' END
           || '_' || lpad(ord::varchar, 9, '0') || 'E' AS name,
         p_name AS label,
         'Topic ' || num::varchar || CASE WHEN num = 3 AND ord % 2 = 1 THEN ' b' ELSE '' END AS concept,
         'B' || lpad(num::varchar, 5, '0') || CASE WHEN num % 5 = 4 THEN 'A' ELSE '' END AS "group",
         CASE WHEN p_size = 1 THEN 'true' END AS required
  FROM parts)"""
