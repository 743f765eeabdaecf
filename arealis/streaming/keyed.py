"""A table of the newest row of each key under a stream of landed responses.

Rows lie in buckets by the hash of their key. A batch reads the buckets it touches, merges its rows
into them and writes them anew, all in one job; a manifest then names the write that holds each
bucket. The manifest is one small file, which the commit of its write puts in place whole: before it
nothing of the batch is seen, after it all of it is. A batch that runs again overwrites its own
write, or finds itself in the manifest and does nothing. A read takes the files the manifest names: no
shuffle, and no row of an older answer.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arealis.sources.responses import broken, response_rows, to_columns
from arealis.streaming.landing import response_stream

#: What tells which of two rows of a key is newer: when its file landed, the file, the place in it.
ORDER = ("landed_at", "path", "position")
_META = "landed_at timestamp, path string, position int"


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    buckets: int = 32

    @property
    def schema(self) -> T.StructType:
        names = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType([*names, *T.StructType.fromDDL(_META).fields])

    def manifest(self) -> dict:
        """``version``, the last batch of each stream, and the write that holds each bucket."""
        try:
            versions = self.spark.read.schema("value string, version long").text(f"{self.path}/manifest")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return {"version": -1, "streams": {}, "buckets": {}}
        newest = versions.agg(F.max_by("value", "version")).first()[0]
        return json.loads(newest) if newest else {"version": -1, "streams": {}, "buckets": {}}

    def _commit(self, manifest: dict) -> None:
        row = self.spark.range(1).select(F.lit(json.dumps(manifest)).alias("value"))
        row.coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/version={manifest['version']}")

    def _files(self, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        places = manifest["buckets"]
        wanted = [str(b) for b in buckets] if buckets is not None else list(places)
        paths = [f"{self.path}/rows/{places[b]}/_bucket={b}" for b in wanted if b in places]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The newest row of each key, as the last batch left them."""
        return self._files(self.manifest()).select(*self.columns)

    def merge(self, rows: DataFrame, batch: int, stream: str = "load") -> bool:
        """Add a batch of ``rows`` (the columns and ``landed_at``, ``path``, ``position``).

        False if the batch is in the table already.
        """
        manifest = self.manifest()
        if manifest["streams"].get(stream, -1) >= batch:
            return False
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        new = rows.select(*self.schema.names).withColumn("_bucket", bucket)
        touched = [r["_bucket"] for r in new.select("_bucket").distinct().collect()]  # as many as buckets at most
        write = f"{stream}-{batch}"
        if touched:
            old = self._files(manifest, touched).withColumn("_bucket", bucket)
            # rows of a bucket are brought together once, for the newest of each key and for the write
            together = new.unionByName(old).repartition("_bucket")
            newest = F.max_by(F.struct(*self.schema.names), F.struct(*ORDER)).alias("r")
            keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate(self.key)]
            merged = together.groupBy("_bucket", *keys).agg(newest).select("_bucket", "r.*")
            merged.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/rows/{write}")
        self._commit(
            {
                "version": manifest["version"] + 1,
                "streams": {**manifest["streams"], stream: batch},
                "buckets": {**manifest["buckets"], **{str(b): write for b in touched}},
            }
        )
        return True


def load_keyed(
    landing: str,
    table: KeyedTable,
    checkpoint: str,
    rejects: str | None = None,
    per_line: bool = False,
    stream: str = "load",
    **options: str,
) -> StreamingQuery:
    """Merge the rows of files that have landed since the last run; texts that are no response go to
    ``rejects``, if named, and are an error otherwise. The query ends when all files are read.

    ``stream`` names the checkpoint: a table can be fed by several, each with a name of its own.
    """

    def write(texts: DataFrame, batch: int) -> None:
        bad = broken(texts)
        if rejects is not None:
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch}")
        elif (first := bad.first()) is not None:
            raise ValueError(f"no response table: {first['path']}")
        table.merge(to_columns(response_rows(texts, "landed_at"), table.columns, *ORDER), batch, stream)

    source = response_stream(table.spark, landing, per_line, **options).writeStream
    return source.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
