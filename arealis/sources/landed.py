"""Landed tables: Parquet, partitioned so that a vintage and a level are read alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.operators.spatial import total_bounds, with_box


def write_landed(df: DataFrame, path: str, *partitions: str, mode: str = "error") -> None:
    keys = partitions or ("vintage", "level")
    df.write.mode(mode).partitionBy(*keys).parquet(path)


def curve_key(x: Column, y: Column, box: tuple[float, float, float, float], bits: int = 16) -> Column:
    """Place on a curve through the box that keeps neighbours together: the bits of both shares, in turn."""

    def spread(c: Column, low: float, high: float) -> Column:
        cells = 2**bits - 1
        share = F.lit(0.0) if high <= low else (c - F.lit(low)) / F.lit(high - low)
        n = F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * cells).cast("long")
        # a gap is opened before each bit, in halves, quarters and so on
        for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            n = n.bitwiseOR(F.shiftleft(n, step)).bitwiseAND(F.lit(mask).cast("long"))
        return n

    return spread(x, box[0], box[2]) + F.lit(2).cast("long") * spread(y, box[1], box[3])


def write_layer(
    df: DataFrame,
    path: str,
    *partitions: str,
    rings: str = "rings",
    files: int | None = None,
    row_group: int = 8 << 20,
    mode: str = "error",
) -> None:
    """Land a layer by position, with box columns, so that row groups hold neighbours and a box query skips
    all but a few by their statistics.

    ``files`` is how many there are about, as Spark decides if not given; ``row_group`` is their bytes.
    """
    box = tuple(total_bounds(df, rings).first())
    boxed = with_box(df, rings)
    if box[0] is None:
        boxed.write.mode(mode).partitionBy(*partitions).parquet(path)
        return
    middle = ((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2)
    keyed = boxed.withColumn("_curve", F.coalesce(curve_key(*middle, box), F.lit(-1).cast("long")))
    keys = [*partitions, "_curve"]
    dealt = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    writer = dealt.sortWithinPartitions(*keys).drop("_curve").write.mode(mode)
    writer.option("parquet.block.size", row_group).partitionBy(*partitions).parquet(path)


def vintages(spark: SparkSession, path: str) -> list[int]:
    """Vintages of a landed table: names of its directories, no file is opened."""
    return _vintages_of(spark.read.parquet(path))


def _vintages_of(table: DataFrame) -> list[int]:
    names = {part for file in table.inputFiles() for part in file.split("/") if part.startswith("vintage=")}
    return sorted(int(n.removeprefix("vintage=")) for n in names)


def read_landed(
    spark: SparkSession, path: str, vintage: int | str = "latest", level: str | None = None
) -> DataFrame:
    """One vintage (the newest by default) and one level or all; a missing vintage raises."""
    table = spark.read.parquet(path)
    known = _vintages_of(table)
    if vintage == "latest":
        vintage = known[-1]
    if int(vintage) not in known:
        raise ValueError(f"vintage must be one of {known}")
    out = table.where(F.col("vintage") == int(vintage))
    return out.where(F.col("level") == level) if level else out
