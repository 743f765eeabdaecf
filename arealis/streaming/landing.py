"""Incremental load of landed response files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arealis.sources.responses import broken, response_rows, to_columns


def response_stream(spark: SparkSession, path: str, per_line: bool = False, **options: str) -> DataFrame:
    """Response texts ``(path, landed_at, value)`` as they land; ``options`` go to the file stream
    (``maxFilesPerTrigger``, ``cleanSource``, …)."""
    reader = spark.readStream.format("text").option("wholetext", not per_line).options(**options)
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        "value",
    )


def load_new(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    columns: Sequence[str],
    rejects: str | None = None,
    per_line: bool = False,
    **options: str,
) -> StreamingQuery:
    """Add the rows of files that have landed since the last run; texts that are no response go
    to ``rejects``, if named, and are an error otherwise.

    Every batch is written to a folder of its own, which a rerun after a failure overwrites, so
    nothing is added twice. No state is kept: :func:`latest` picks the newest row of a key when the
    table is read. The query ends when all files are read.
    """

    def write(texts: DataFrame, batch: int) -> None:
        bad = broken(texts)
        if rejects is not None:
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch}")
        elif (first := bad.first()) is not None:
            raise ValueError(f"no response table: {first['path']}")
        rows = to_columns(response_rows(texts, "landed_at"), columns, "path", "position", "landed_at")
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    stream = response_stream(spark, landing, per_line, **options).writeStream
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest row of each key of a loaded table: of the last file that landed, there the last row."""
    names = [c for c in rows.columns if c not in ("path", "position", "landed_at", "batch")]
    newest = F.max_by(F.struct(*names), F.struct("landed_at", "batch", "path", "position")).alias("r")
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in key)).agg(newest).select("r.*")
