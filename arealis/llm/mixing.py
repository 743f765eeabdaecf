"""Mixing sources to target weights: raking of token weights, then sampling of documents.

Documents are cells by source, language and topic. Iterative proportional fitting multiplies the
cells' token weights by one factor per source, language and topic until all three marginals meet
their targets. A document is sampled with the probability of its cell, min(1, c * weight), where the weight is
its fitted share over its own and c is solved over the cells so that the expected tokens meet a budget. Cells
at probability 1 are taken whole and nothing is repeated, so they fall short of their target. Without a budget
the sample is the largest in which the fitted weight that so goes missing is at most ``MISSING``, and holds
``LEAST`` of all tokens at least; a few rare values, whose weights are large, take part in it whole and don't
shrink the rest. The draw is a hash of the seed, the id and the text, so it doesn't depend on partitions or on
a task that runs again.

Fitting goes on until the marginals are met or come no nearer: contrary targets, or values that share no
documents, can't all be met. What is left is told as ``gap``, the largest difference of a marginal's share from
its target; ``reached`` compares, value by value, the fitted shares with those that the sample is expected to have.

Targets are tables (value, share); by default a marginal's shares are tempered, share ** ``TEMPER``
made to sum to 1, which lifts small sources and languages. A target value that no document has is
left out and the others scaled up; documents of a value without a target are never sampled.

The topic is lexical: words of five letters or more vote by hash for one of ``TOPICS`` topics, the most
votes win, ties go to the lower number, texts without such words are topic 0. Tokens are words.

Cells, marginals and factors stay tables throughout. Defined results: null sources and languages are values
of their own; a text without words weighs 0 and is sampled like its cell (a cell without any weight:
never); repeated rows weigh and are drawn alike; an empty table gives no rows; columns of the input keep
their names whatever they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import Recent, documents, land

MARGINS = ("source", "lang", "topic")
TOPICS = 8
TEMPER = 0.5
TOLERANCE = 1e-6
#: Fitting ends where the gap has not fallen to this part of itself over so many rounds.
FALLING, OVER_ROUNDS = 0.95, 5
#: Fitted weight that cells taken whole may lack where no budget is given.
MISSING = 0.02
#: Share of all tokens that a sample without a budget holds at least.
LEAST = 0.25


class Topics(Recent):
    def made(self, word: str) -> int:
        return xxhash.xxh64_intdigest(word.lower()) % TOPICS if len(word) >= 5 and word.isalpha() else TOPICS

    def of(self, text: str | None) -> tuple[int, int]:
        """Topic and number of words."""
        words = (text or "").split()
        votes = np.bincount(np.fromiter(map(self.__getitem__, words), np.int64, len(words)), minlength=TOPICS + 1)
        return int(votes[:TOPICS].argmax()), len(words)


def profiled(docs: DataFrame, carry: list[Column], text_column: str = "text") -> DataFrame:
    """Columns c0, c1, … (``carry``), then source and lang as keys, topic, tokens and the draw."""
    rows = docs.select(
        *(c.alias(f"c{i}") for i, c in enumerate(carry)),
        *(F.coalesce(F.concat(F.lit("="), F.col(f"`{m}`").cast("string")), F.lit("")).alias(m) for m in MARGINS[:2]),
        F.col(f"`{text_column}`").alias("text"),
    )
    added = [("topic", T.StringType()), ("tokens", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        topics = Topics()
        for batch in batches:
            found = [topics.of(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            new = [pa.array([str(f[0]) for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], "topic", "tokens"]
            )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *(T.StructField(*a) for a in added)]))


def draw(seed: int, id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Uniform in [0, 1), fixed for an id and a text."""
    mixed = F.xxhash64(F.lit(seed), F.col(f"`{id_column}`").cast("string"), F.col(f"`{text_column}`"))
    return F.shiftrightunsigned(mixed, 11) / F.lit(float(1 << 53))


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """Target of a marginal: its shares, tempered."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("n")).where("n > 0")
    return sums.select("value", F.pow(F.col("n").cast("double"), power).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``fitted``, whose marginals meet the targets, and ``gap``."""
    rows = cells.where("tokens > 0").withColumn("fitted", F.col("tokens").cast("double"))
    for margin in MARGINS:
        wanted = (targets or {}).get(margin) or tempered(cells, margin)
        known = wanted.join(rows.select(F.col(margin).alias("value")).distinct(), "value")
        total = known.agg(F.sum("share")).first()[0] or 1.0
        share = known.select(F.col("value").alias(margin), (F.col("share") / total).alias(f"t_{margin}"))
        rows = land(rows.join(share, margin), "cells")
    gaps: list[float] = []
    while not gaps or (gaps[-1] >= TOLERANCE and not _stuck(gaps)):
        now = rows
        for margin in MARGINS:
            sums = now.groupBy(margin).agg(F.sum("fitted").alias("now"))
            scaled = F.when(F.col("now") > 0, F.col("fitted") * F.col(f"t_{margin}") / F.col("now")).otherwise(0.0)
            now = now.join(sums, margin).withColumn("fitted", scaled).drop("now")
        rows = land(now, "cells")
        gaps.append(_gap(rows))
    return rows.select(*MARGINS, "tokens", "fitted", F.lit(gaps[-1]).alias("gap"))


def _stuck(gaps: list[float]) -> bool:
    return len(gaps) > OVER_ROUNDS and gaps[-1] > FALLING * gaps[-1 - OVER_ROUNDS]


def _gap(rows: DataFrame) -> float:
    """Largest difference of a marginal from its target."""
    gap = 0.0
    for margin in MARGINS[:-1]:  # the last one has just been met
        sums = rows.groupBy(margin).agg(F.sum("fitted").alias("now"), F.first(f"t_{margin}").alias("t"))
        gap = max(gap, sums.agg(F.max(F.abs(F.col("now") - F.col("t")))).first()[0] or 0.0)
    return gap


def _scale(weighted: DataFrame, total: float, budget: float | None) -> float:
    """c of the probabilities min(1, c * weight), whose expected tokens meet ``budget`` (tokens).

    The expected share is concave in c, so Newton's steps from one side never pass the solution and end there.
    """

    def split(c: float) -> tuple[float, float]:
        """Share of the tokens in cells taken whole, fitted weight of the others."""
        whole = F.col("weight") * c >= 1
        row = weighted.where("weight > 0").agg(
            F.sum(F.when(whole, F.col("tokens") / total).otherwise(0.0)),
            F.sum(F.when(whole, 0.0).otherwise(F.col("fitted"))),
        ).first()
        return row[0] or 0.0, row[1] or 0.0

    def of_share(share: float) -> float:
        c = share
        while True:
            taken, rest = split(c)
            if rest <= 0:  # all cells are whole
                return c
            later = (share - taken) / rest
            if later <= c * (1 + 1e-12):
                return c
            c = later

    if budget is not None:
        return of_share(budget / total)
    c = 1 / (1 - MISSING)
    while True:
        taken, rest = split(c)
        earlier = taken / (1 - MISSING - rest) if rest < 1 - MISSING else c
        if earlier >= c * (1 - 1e-12) or earlier <= 0:
            break
        c = earlier
    taken, rest = split(c)
    return c if taken + c * rest >= LEAST else of_share(LEAST)


def probabilities(
    profile: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float | None = None
) -> DataFrame:
    """Cells with ``weight`` (fitted over own share), ``probability`` and ``gap``; ``budget``: tokens to expect."""
    cells = land(profile.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    weighted = land(rake(cells, targets).withColumn("weight", F.col("fitted") * total / F.col("tokens")), "weights")
    probability = F.least(F.lit(1.0), F.col("weight") * _scale(weighted, total, budget))
    return weighted.select(*MARGINS, "tokens", "fitted", "weight", probability.alias("probability"), "gap")


def reached(weights: DataFrame) -> DataFrame:
    """(margin, value, wanted, expected): shares that were fitted, and those of the expected sample."""
    drawn = F.col("tokens") * F.col("probability")
    total = weights.agg(F.sum(drawn)).first()[0] or 1.0
    parts = [
        weights.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(
            F.sum("fitted").alias("wanted"), (F.sum(drawn) / F.lit(float(total))).alias("expected")
        )
        for m in MARGINS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sampled(
    docs: DataFrame, seed: int = 1, targets: dict[str, DataFrame] | None = None, budget: float | None = None
) -> DataFrame:
    """The rows of ``docs`` that are drawn, with its columns."""
    weights = probabilities(profiled(docs, []), targets, budget).select(*MARGINS, "probability")
    carry = [F.col(f"`{c}`") for c in docs.columns] + [draw(seed)]
    names = [f"c{i}" for i in range(len(carry))]
    drawn = profiled(docs, carry).join(weights, list(MARGINS)).where(F.col(names[-1]) < F.col("probability"))
    return drawn.select(*names[:-1]).toDF(*docs.columns)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = land(profiled(docs, [F.col("doc_id"), F.col("source"), F.col("lang"), draw(1)]), "profile")
    weights = probabilities(rows).drop("tokens", "fitted")
    return rows.join(weights, list(MARGINS), "left").select(
        F.col("c0").alias("doc_id"),
        F.col("c1").alias("source"),
        F.col("c2").alias("lang"),
        F.col("topic").cast("int").alias("topic"),
        F.col("tokens").alias("n_tokens"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
        (F.col("c3") < F.coalesce("probability", F.lit(0.0))).alias("sampled"),
        "gap",
    )


QUERIES = {"op2_mixing": op2_mixing}
ORACLE: dict[str, str] = {}
