"""Area code tables and support tables from landed text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions import ids
from arealis.sources import lines


# File of each kind, its separator, and its columns where it has no header.
# Columns without a published name keep positions, as many as the longest line has.
KINDS = {
    "AIA": ("aia.txt", ",", ()),
    "COUNTY": ("county.txt", ",", ("STATE", "STATEFP", "COUNTYFP", "COUNTYNAME", "CLASSFP")),
    "SUBCOUNTY": (
        "cousub.txt",
        ",",
        ("STATE", "STATEFP", "COUNTYFP", "COUNTYNAME", "COUSUBFP", "COUSUBNAME", "FUNCSTAT"),
    ),
    "PLACE": ("places.txt", "|", None),
    "SCHOOLDISTRICT": ("schdist.txt", ",", ()),
    "VTD": ("vtd.txt", "|", None),
}


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """State codes: ``(abbreviation, fips, name)``, the code with two digits."""
    raw = lines.fitting(lines.parsed(spark, path, lines.texts("abbreviation", "fips", "name"), header=True))
    return raw.withColumn("fips", ids.pad_left("fips", 2))


def find_state(states: DataFrame, state: str) -> DataFrame:
    """The state given by abbreviation, name or code (with or without leading zero)."""
    text = str(state).upper()
    hit = (
        (F.upper("abbreviation") == text)
        | (F.upper("name") == text)
        | (F.col("fips") == text.rjust(2, "0"))
    )
    return states.where(hit)


def _area_codes(spark: SparkSession, root: str, kind: str) -> DataFrame:
    kind = kind.upper().replace(" ", "")
    if kind not in KINDS:
        raise ValueError(f"kind must be one of STATE, {', '.join(KINDS)}")
    file, sep, names = KINDS[kind]
    path, encoding = f"{root}/national_{file}", "ISO-8859-1"
    if names is None:
        names = spark.read.options(sep=sep, encoding=encoding, header=True).csv(path).columns
        return lines.parsed(spark, path, lines.texts(*names), sep, encoding=encoding, header=True)
    if not names:
        names = [f"c{i}" for i in range(lines.widest(spark, path, sep, encoding))]
    return lines.parsed(spark, path, lines.texts(*names), sep, encoding=encoding)


def rejected_area_codes(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Rows of the file that have more cells than it has columns: ``(path, line, read)``."""
    return lines.rejected(_area_codes(spark, root, kind))


def read_area_codes(
    spark: SparkSession, root: str, kind: str, states: DataFrame, in_state: str = ""
) -> DataFrame:
    """Codes and names of one kind of area, national or for one state.

    Files lie as ``root/national_<kind file>``; the rows of a state are chosen by the
    abbreviation in the first column. Rows that do not fit are left out, see
    :func:`rejected_area_codes`.
    """
    if kind.upper() == "STATE":
        return states
    table = lines.fitting(_area_codes(spark, root, kind))
    if not in_state:
        return table
    wanted = find_state(states, in_state).select("abbreviation")
    if wanted.isEmpty():
        raise ValueError(f"no state with abbreviation, name or code {in_state!r}")
    return table.join(wanted, F.col(table.columns[0]) == F.col("abbreviation"), "left_semi")


def gazetteer(places: DataFrame) -> DataFrame:
    """Place codes with padded ids: ``(STATE, STATEFP, TARGETFP, TARGETNAME, TYPE)``."""
    return places.select(
        "STATE",
        ids.pad_left("STATEFP", 2).alias("STATEFP"),
        ids.pad_left("PLACEFP", 5).alias("TARGETFP"),
        F.col("PLACENAME").alias("TARGETNAME"),
        "TYPE",
    )


_POPULATIONS = "population double, name string, geoid string, state string"
_WEIGHTS = "fips string, avg_weight double"


def _support(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return lines.parsed(spark, path, T.StructType.fromDDL(ddl), header=True)


def read_populations(spark: SparkSession, path: str) -> DataFrame:
    """Population table of one year and level: ``(geoid, population, name, state)``."""
    raw = lines.fitting(_support(spark, path, _POPULATIONS))
    return raw.select("geoid", "population", "name", ids.pad_left("state", 2).alias("state"))


def rejected_populations(spark: SparkSession, path: str) -> DataFrame:
    return lines.rejected(_support(spark, path, _POPULATIONS))


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """Average weights by state: ``(fips, avg_weight)``; codes are padded in every year."""
    raw = lines.fitting(_support(spark, path, _WEIGHTS))
    return raw.select(ids.pad_left("fips", 2).alias("fips"), "avg_weight")


def rejected_weights(spark: SparkSession, path: str) -> DataFrame:
    return lines.rejected(_support(spark, path, _WEIGHTS))
