"""Fuzzy matching of area names.

The names to look up are arguments (a short list). A candidate's scores have an upper bound that
follows from lengths, shared trigrams and shared letters alone, so it is worked out by built-in
functions. The candidate that shares most trigrams with a name is scored first; the matcher then sees
only candidates whose bound reaches that score. None is lost:

M letters in k matching blocks hold at least M - 2k shared trigrams. Between two blocks lies an unmatched
letter of one text or the other, so k - 1 is at most (p - M) + (q - M) for texts of p and q letters, and
t shared trigrams allow no more than (t + 2 (p + q) + 2) / 5 matched letters. Nor can more letters match
than both texts have in common.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import full_score, partial_score, score_columns, split_query, trigrams
from arealis.session import land

#: Columns of a name and a candidate.
_PAIR = ("query", "name", "low", "target", "position")


_ASKED = "array<struct<query:string,name:string,state:string,grams:array<string>,again:int,letters:array<struct<c:string,n:int>>>>"


def _queries(names: Sequence[str]) -> Column:
    """The names as an array of structs, one constant of the plan."""
    rows = []
    for query in names:
        name, state = split_query(query)
        grams = [name[i : i + 3] for i in range(len(name) - 2)]
        different = list(dict.fromkeys(grams))
        letters = [{"c": c, "n": n} for c, n in Counter(name).items()]
        rows.append(
            {"query": query, "name": name, "state": state, "grams": different, "again": len(grams) - len(different), "letters": letters}
        )
    return F.from_json(F.lit(json.dumps(rows)), _ASKED)


def _pairs(slim: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each name with the candidates of its state, and the trigrams that they share."""
    low = F.coalesce(F.lower("target"), F.lit(""))
    rows = slim.select("target", "position", low.alias("low"))
    of_state = F.filter(_queries(names), lambda q: q["state"].isNull() | F.endswith(F.col("low"), q["state"]))
    met = rows.select("*", F.inline_outer(of_state)).where("query IS NOT NULL")
    shared = F.size(F.array_intersect(trigrams(F.col("low")), "grams")) + F.col("again")
    return met.select(*_PAIR, "letters", shared.alias("shared"))


def _score_bound(partial: bool) -> Column:
    """Upper bound of the partial or the full score of ``name`` and ``low``, as a whole number."""
    common = """aggregate(letters, 0, (acc, x) -> acc + least(x.n, length(low) - length(replace(low, x.c, ''))))"""
    if partial:  # the shorter text and a window of the longer one, of at most its length
        size = "least(length(name), length(low))"
        most = f"least({size}, floor((shared + 4 * {size} + 2) / 5), {common})"
        bound = f"200 * {most} / ({size} + {most})"
    else:
        size = "(length(name) + length(low))"
        bound = f"200 * least(floor((shared + 2 * {size} + 2) / 5), {common}) / {size}"
    return F.expr(f"if(length(name) = 0 OR length(low) = 0, 0, cast(ceil({bound}) AS int))")


def _best_of_batch(batches):
    """Per batch the best candidates of each name, with the number of rows that tie with the first."""
    for pdf in batches:
        rows = []
        for (query, name), some in pdf.groupby(["query", "name"], sort=False):
            # copies of a target score alike: one row for each, with their number
            table = some.sort_values(["position", "target"]).groupby("low", sort=False).agg(
                position=("position", "first"), target=("target", "first"), n=("position", "size")
            )
            score = table.index.map(lambda t: partial_score(name, t))
            table = table[score == score.max()]
            second = table.index.map(lambda t: full_score(name, t))
            table = table[second == second.max()]
            first = table.loc[table["position"].idxmin()]
            rows.append((query, score.max(), second.max(), int(table["n"].sum()), first["position"], first["target"]))
        yield pd.DataFrame(rows, columns=["query", "score", "score2", "n", "position", "target"])


def best_matches(
    candidates: DataFrame | NameIndex,
    names: str | Sequence[str],
    target: str = "target",
    position: str = "position",
) -> DataFrame:
    """Best candidate of each name: ``(query, target, position, score, score2, ambiguous)``.

    ``"name, state"`` looks only at candidates that end in the state. The partial score
    decides, then the score of the whole strings, then the position of the candidate, a
    unique number or text that gives the order of the table. ``ambiguous`` tells that the
    position had to decide. A name without candidates in its state has no row.

    ``candidates`` is a table, or an index of one, in which only postings of the names' trigrams are read.
    """
    names = [names] if isinstance(names, str) else list(dict.fromkeys(names))
    if isinstance(candidates, NameIndex):
        pairs, floor = candidates.pairs(names)
    else:
        slim = candidates.select(F.col(target).alias("target"), F.col(position).alias("position"))
        pairs = _pairs(slim, names)
        floor = _floor(pairs)
    kind = pairs.schema["position"].dataType.simpleString()
    reach = pairs.join(F.broadcast(floor), "query", "left")  # one row per name
    score, score2 = (F.coalesce(c, F.lit(0)) for c in ("score", "score2"))
    able = (_score_bound(True) > score) | ((_score_bound(True) == score) & (_score_bound(False) >= score2))
    schema = f"query string, score int, score2 int, n long, position {kind}, target string"
    partial = reach.where(able).select(*_PAIR).mapInPandas(_best_of_batch, schema)
    ties = partial.groupBy("query", "score", "score2").agg(
        F.sum("n").alias("n"), F.min(F.struct("position", "target")).alias("first")
    )
    rank = F.struct("score", "score2", "n", F.col("first.position"), F.col("first.target"))
    best = ties.groupBy("query").agg(F.max_by(rank, F.struct("score", "score2")).alias("b"))
    return best.select(
        "query",
        F.col("b.target").alias("target"),
        F.col("b.position").alias("position"),
        F.col("b.score").alias("score"),
        F.col("b.score2").alias("score2"),
        (F.col("b.n") > 1).alias("ambiguous"),
    )


def _floor(pairs: DataFrame) -> DataFrame:
    """(query, score, score2) of the candidate that shares most trigrams with each name."""
    nearest = F.struct("shared", -F.abs(F.length("low") - F.length("name")), "low", "name")
    most = pairs.groupBy("query").agg(F.max(nearest).alias("m")).coalesce(1)  # one row per name

    def scored(batches):
        for pdf in batches:
            both = list(zip(pdf["name"], pdf["low"]))
            yield pd.DataFrame(
                {
                    "query": pdf["query"],
                    "score": [partial_score(*x) for x in both],
                    "score2": [full_score(*x) for x in both],
                }
            )

    return most.select("query", "m.name", "m.low").mapInPandas(scored, "query string, score int, score2 int")


@dataclass(frozen=True)
class NameIndex:
    """A landed table of names and one of their trigrams, sorted by trigram, with document frequencies."""

    rows: DataFrame  # target, position, low, length
    postings: DataFrame  # gram, low
    frequencies: DataFrame  # gram, df

    @classmethod
    def build(cls, candidates: DataFrame, target: str = "target", position: str = "position") -> NameIndex:
        low = F.coalesce(F.lower(target), F.lit(""))
        rows = candidates.select(F.col(target).alias("target"), F.col(position).alias("position"), low.alias("low"))
        rows = land(rows.withColumn("length", F.length("low")).repartitionByRange("low").sortWithinPartitions("low"), "names")
        grams = rows.select("low").distinct().select(F.explode(trigrams(F.col("low"))).alias("gram"), "low")
        # sorted, so that a row group holds few trigrams and a lookup skips the others
        postings = land(grams.repartitionByRange("gram", "low").sortWithinPartitions("gram", "low"), "postings")
        frequencies = land(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "frequencies")
        return cls(rows, postings, frequencies)

    def pairs(self, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Pairs of a name and a candidate that can be its best, and the floor of each name.

        The floor comes from the postings of a name's rarest trigram. A candidate that reaches it shares
        so many trigrams that it has one of the rarest; texts too short for that are found by length.
        """
        spark = self.rows.sparkSession
        asked = land(spark.range(1).select(F.inline(_queries(names))), "asked")
        grams = asked.select("query", F.explode("grams").alias("gram")).join(self.frequencies, "gram")
        order = grams.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("rare"))
        ranked = land(asked.join(order, "query", "left"), "ranked")  # one row per name
        seeds = ranked.select("query", F.explode(F.slice("rare.gram", 1, 4)).alias("gram"))
        floor = land(_floor(self._met(ranked, self._holding(seeds))), "floor")
        # least matched letters of a score, from the bound; then the least shared trigrams
        size = F.length("name")
        share = (F.col("score") - 1) / 100
        letters = F.ceil(share * size / (2 - share))
        least = 5 * letters - 4 * size - 2 - F.col("again")
        told = ranked.join(floor, "query", "left").withColumn("least", F.coalesce(least, F.lit(0)))
        # a text shorter than the name is its own measure: it is taken by its length
        prefix = F.slice("rare.gram", 1, F.greatest(F.size("grams") - F.col("least") + 1, F.lit(0)).cast("int"))
        rare = told.where("least > 0").select("query", F.explode(prefix).alias("gram"))
        below = F.when(F.col("least") > 0, size).otherwise(F.lit(2**31 - 1))  # without a floor any length will do
        short = told.select("query", below.alias("below"))
        by_length = self.rows.join(F.broadcast(short), F.col("length") < F.col("below")).select("query", "low")
        found = self._holding(rare).unionByName(by_length).distinct()
        return self._met(ranked, found), floor

    def _holding(self, grams: DataFrame) -> DataFrame:
        """(query, low) of the names that hold any of a query's trigrams."""
        return self.postings.join(F.broadcast(grams), "gram").select("query", "low").distinct()

    def _met(self, asked: DataFrame, found: DataFrame) -> DataFrame:
        rows = self.rows.join(found, "low").join(F.broadcast(asked.drop("rare")), "query")
        shared = F.size(F.array_intersect(trigrams(F.col("low")), "grams")) + F.col("again")
        return rows.where("state IS NULL OR endswith(low, state)").select(*_PAIR, "letters", shared.alias("shared"))


def match_table(candidates: DataFrame, name: str, target: str = "target") -> DataFrame:
    """All candidates with their two scores, worst first."""
    lowered, state = split_query(name)
    pool = candidates
    if state is not None:
        pool = pool.where(F.lower(target).endswith(state))
    scored = pool.withColumn("_s", score_columns(F.col(target), lowered))
    out = scored.select(*candidates.columns, "_s.score", "_s.score2")
    return out.orderBy("score", "score2")


def names_with_state(areas: DataFrame, states: DataFrame) -> DataFrame:
    """``BASENAME`` -> ``"BASENAME, XX"`` by the state code (``states (STATE, abbreviation)``).

    Without an abbreviation the name stays as it is.
    """
    joined = areas.join(states.select("STATE", "abbreviation"), "STATE", "left")
    return joined.withColumn("BASENAME", F.concat_ws(", ", "BASENAME", "abbreviation"))
