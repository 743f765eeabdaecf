"""Secret scans over an incremental ledger of content-addressed texts (native).

A text version is a blob, named by the SHA-256 of its bytes. The ledger is a table of the blobs
scanned so far and their findings, by version of the rules. A run scans only blobs that the ledger
lacks under the current version (one copy of each), adds them, and joins the findings back to every
path that has or had the blob.

Findings of a kind are leftmost and don't overlap; their place is computed in SQL from the lengths of
what lies between matches. Kinds beyond the three base ones: ``pem`` (private key headers), ``jwt``
(signed web tokens), ``provider`` (keys with a published vendor prefix).

Defined results: a null text is empty and has no findings; repeated rows and copies share one blob;
null paths are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealis.llm.common import content, documents, land, located
from arealis.session import scratch_path

#: Kind, pattern, group whose length counts, least length, literal without which nothing matches.
RULES: tuple[tuple[str, str, int, int, str], ...] = (
    (
        "assign",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        1,
        6,
        "",
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    ("hex", r"[0-9a-f]{24,}", 0, 24, ""),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1, "eyJ"),
    ("provider", r"\b(?:ghp_|gho_|ghs_|glpat-|xoxb-|xoxp-|sk_live_|AIza)[A-Za-z0-9_-]{16,}", 0, 1, ""),
)
BASE = ("assign", "access", "hex")
VERSION = "1"


def _matches(text: Column, rank: int) -> Column:
    """Array of (rank of the kind, number, length before it, length, length that counts) of all matches."""
    _, pattern, group, _, literal = RULES[rank]
    rx = F.lit(pattern)
    steps = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all(text, rx, F.lit(0)), lambda x: F.length(x)).alias("size"),
        F.transform(F.regexp_extract_all(text, rx, F.lit(group)), lambda x: F.length(x)).alias("counts"),
    )
    rows = F.transform(
        F.filter(steps, lambda s: s["size"].isNotNull()),
        lambda s, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("i"), s["gap"].alias("gap"), s["size"].alias("size"), s["counts"].alias("counts")
        ),
    )
    possible = F.contains(text, F.lit(literal)) & F.rlike(text, rx) if literal else F.rlike(text, rx)
    nothing = F.array().cast("array<struct<rank:int,i:int,gap:int,size:int,counts:int>>")
    return F.when(possible, rows).otherwise(nothing)


def scan(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of the blobs (blob, text) that have any.

    A finding is (start, rank, end, kind), in order. Places are running sums over the matches of a blob.
    """
    found = F.concat(*(_matches(F.col("text"), rank) for rank in range(len(RULES))))
    so_far = Window.partitionBy("blob", "rank").orderBy("i")
    least = F.array(*(F.lit(r[3]) for r in RULES))
    kinds = F.array(*(F.lit(r[0]) for r in RULES))
    end = F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int")
    return (
        blobs.select("blob", F.inline(found))
        .withColumn("end", end)
        .where(F.col("counts") >= least[F.col("rank")])
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct((F.col("end") - F.col("size")).alias("start"), "rank", "end", kinds[F.col("rank")].alias("kind"))
                )
            ).alias("findings")
        )
    )


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        return None


def scan_new(versions: DataFrame, ledger: str, path_column: str = "path", text_column: str = "text") -> DataFrame:
    """Bring the ledger up to date with ``versions`` (one row per path and version of its text).

    Returns ``path``, ``blob`` and ``findings`` of every row, whether scanned now or earlier.
    """
    spark = versions.sparkSession
    rows = located(versions, {"path": F.col(f"`{path_column}`"), "text": content(text_column)})
    names = rows.select("path", F.sha2("text", 256).alias("blob"), "_file", "_row")
    known = _ledger(spark, ledger)
    todo = names.groupBy("blob").agg(F.min(F.struct("_file", "_row")).alias("one"))
    if known is not None:
        todo = todo.join(known.where(F.col("version") == VERSION).select("blob"), "blob", "left_anti")
    todo = land(todo.select("blob", "one._file", "one._row"), "unseen")
    found = scan(rows.join(todo, ["_file", "_row"]).select("blob", "text"))
    nothing = F.array().cast(found.schema["findings"].dataType)
    (
        todo.join(found, "blob", "left")
        .select("blob", F.lit(VERSION).alias("version"), F.coalesce("findings", nothing).alias("findings"))
        .write.mode("append")
        .parquet(ledger)
    )
    findings = spark.read.parquet(ledger).where(F.col("version") == VERSION).drop("version")
    return names.select("path", "blob").join(findings, "blob")


def _text(findings: Column, kinds: tuple[str, ...] | None = None) -> Column:
    some = F.filter(findings, lambda f: f["kind"].isin(*kinds)) if kinds else findings
    return F.array_join(
        F.transform(some, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = os.path.join(scratch_path(spark, "ledger"), "blobs")
    found = scan_new(documents(spark, sf_dir), ledger, "doc_id")
    return found.select(
        F.col("path").alias("doc_id"),
        *(_count(kind) for kind in BASE),
        F.sha2(_text(F.col("findings"), BASE), 256).alias("base_sha256"),
        _text(F.col("findings")).alias("spans"),
    )


QUERIES = {"op9_secret_scan": op9_secret_scan}
ORACLE: dict[str, str] = {}
