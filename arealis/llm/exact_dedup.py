"""Exact deduplication as a stateful stream with disk-backed state (native).

Rows are streamed as (digest, identifier, content locator). The keyed state (RocksDB, no
watermark, so no expiry) keeps, per digest, the identifier and locator of the row that stays
and the number of rows. Rows whose digest another row also has are hits: their whole texts
are compared with the text of the row that stays, and rows that differ are grouped anew by
their texts, so a digest collision never drops a document.

Defined results: a null text is empty; empty texts are equal to each other. Of equal texts the
largest doc_id stays (a null doc_id counts as smallest); of repeated rows with that doc_id the
one at the largest locator stays. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import content, documents, filed, land, located, lower_ascii
from arealis.session import scratch_path

#: State on disk; files grow with the state instead of being preallocated for every partition.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def ledger(feed: DataFrame, checkpoint: str) -> DataFrame:
    """Run the stream ``feed`` (digest, id, _file, _row) to its end; the state as a table.

    Called again with the same checkpoint, it takes up where it stopped: only files that are
    new are read, and state of earlier runs counts.
    """
    spark = feed.sparkSession
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        (
            feed.groupBy("digest")
            .agg(F.max(F.struct("id", "_file", "_row")), F.count(F.lit(1)))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        state = spark.read.format("statestore").load(checkpoint)
        return land(
            state.select("key.digest", F.col("value.max").alias("stays"), F.col("value.count").alias("n")),
            "digests",
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = 100_000,
) -> DataFrame:
    """One row per input row: id, _file, _row, digest, keep_id, group_size, kept."""
    spark = docs.sparkSession
    texts = located(
        docs, {"id": F.col(f"`{id_column}`"), "norm": lower_ascii(content(text_column))}
    )
    columns = ["digest", "id", "_file", "_row"]
    path = scratch_path(spark, "feed")
    texts.withColumn("digest", digest(F.col("norm"))).select(columns).write.parquet(path)
    rows = spark.read.parquet(path)
    stream = (
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
    state = ledger(stream, scratch_path(spark, "state"))
    place = F.struct("id", "_file", "_row")
    found = rows.join(state, "digest").select(
        *columns,
        F.col("stays.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        place.eqNullSafe(F.col("stays")).alias("kept"),
    )
    differ = _differing(texts.withColumn("digest", digest(F.col("norm"))), state)
    if differ.isEmpty():
        return found
    return _regrouped(found, differ)


def _differing(texts: DataFrame, state: DataFrame) -> DataFrame:
    """Rows with the digest of another row but not the bytes of the row that stays."""
    hits = land(
        texts.join(state.where("n > 1").select("digest", "stays"), "digest").select(
            "digest", "norm", "id", "_file", "_row",
            F.struct("id", "_file", "_row").eqNullSafe(F.col("stays")).alias("stays"),
        ),
        "hits",
    )
    stay = hits.where("stays").select("digest", F.col("norm").alias("other"))
    return land(
        hits.where("not stays").join(stay, "digest").where("norm != other").drop("other", "stays"),
        "differ",
    )


def _regrouped(found: DataFrame, differ: DataFrame) -> DataFrame:
    """Rows that differ from the row that stays form groups of their own, by whole text."""
    groups = differ.groupBy("digest", "norm").agg(
        F.max(F.struct("id", "_file", "_row")).alias("own"), F.count(F.lit(1)).alias("own_n")
    )
    own = differ.join(groups, ["digest", "norm"]).select("_file", "_row", "own", "own_n")
    gone = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    place = F.struct("id", "_file", "_row")
    return (
        found.join(own, ["_file", "_row"], "left")
        .join(gone, "digest", "left")
        .select(
            "digest", "id", "_file", "_row",
            F.when(F.col("own").isNull(), F.col("keep_id")).otherwise(F.col("own.id")).alias("keep_id"),
            F.coalesce("own_n", F.col("group_size") - F.coalesce("gone", F.lit(0))).alias("group_size"),
            F.when(F.col("own").isNull(), F.col("kept")).otherwise(place.eqNullSafe(F.col("own"))).alias("kept"),
        )
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    docs = filed(docs)
    stays = exact_dedup(docs).where("kept").select(F.col("_file").alias("_the_file"), F.col("_row").alias("_the_row"))
    here = [F.col("_metadata.file_path") == stays["_the_file"], F.col("_metadata.row_index") == stays["_the_row"]]
    return docs.join(stays, here, "left_semi")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


QUERIES = {"op1_exact_dedup": op1_exact_dedup}

ORACLE = {
    "op1_exact_dedup": """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
}
