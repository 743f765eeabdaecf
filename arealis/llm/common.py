"""Shared steps of the operators: landing tables, row locators, normal texts, words met lately."""

from __future__ import annotations

import string
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis import session as shared

#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Spark then deletes the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: lineage ends here.

    What was shuffled for it isn't needed any more and is deleted, so that a chain of steps takes
    the disk of its largest one.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    path = shared.scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def release(*landed: DataFrame) -> None:
    """Empty the files of landed tables that nothing reads any more, in whatever store they are."""
    for df in landed:
        df.sparkSession.range(0).write.mode("overwrite").parquet(df._landed_at)


class Recent(dict):
    """What :meth:`made` gives for words, worked out once for those met again soon.

    At most ``kept`` of them: what was met since the last half of that many, and what was met before. The
    former are looked up directly, and the latter move up when they come again, so common words stay.
    """

    kept = 600_000
    #: Characters of the longest word that is kept.
    longest = 100

    def __init__(self) -> None:
        super().__init__()
        self.older: dict[str, Any] = {}

    def made(self, word: str) -> Any:
        raise NotImplementedError

    def __missing__(self, word: str) -> Any:
        value = self.older.pop(word, None)
        if value is None:
            value = self.made(word)
        if len(word) <= self.longest:
            if len(self) >= self.kept // 2:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}


def filed(docs: DataFrame) -> DataFrame:
    """``docs`` as a plain file scan, whose rows have a fixed place; landed if it isn't one."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return land(docs, "rows")
    return docs


def located(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``columns`` of every row and its content locator ``_file``, ``_row``."""
    place = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    return filed(docs).select(*(c.alias(n) for n, c in {**columns, **place}.items()))


def content(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else; a text of ASCII alone takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
