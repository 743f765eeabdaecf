"""A training corpus in five stages: quality, exact and near copies, mixing, packing.

Each stage takes what its predecessor kept, written as Parquet and read again. The rows that a stage keeps
keep all their columns, whatever their names.

Defined results of the stages. An empty table gives no rows. Null texts are empty texts. Texts of any
length are read whole. A row without an id is judged like others by quality and mixing, is one of its equal
texts for the exact stage, and stays in the near stage, where it is linked with nothing; packing keeps it. Rows that
are repeated are equal texts. Ties: of equal texts the largest id stays, of near copies the smallest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm import exact_dedup, mixing, near_dedup, packing, quality_classifier
from arealis.llm.common import documents, land

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of these documents."""
    stats = land(quality_classifier.text_statistics(docs, [F.col("doc_id")]), "statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(quality_classifier.labelled_statistics(stats, labels))
    return quality_classifier.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that meets the target weights of sources, languages and topics."""
    return mixing.sampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sampled documents with their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mix", mix),
    ("pack", pack),
]

#: Not expressible in SQL: the classifier, the groups and the raking are iterative.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL}
