"""Patterns and string similarity."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.numbers import col


def glob_to_regex(pattern: str) -> str:
    """Anchored regular expression of a glob, in the syntax Java reads."""
    translated = fnmatch.translate(pattern)
    inner = re.fullmatch(r"\(\?s:(.*)\)\\[zZ]", translated, flags=re.S)
    body = inner.group(1) if inner else translated
    return f"(?s)\\A(?:{body})\\z"


def matches(
    c: Column | str, pattern: str, engine: str | Callable[[str, str], bool] = "re"
) -> Column:
    """Does the text match? NULL counts as the empty string.

    ``engine`` is ``re`` (search anywhere), ``fnmatch`` (whole text) or a function
    ``(candidate, pattern) -> bool``, which runs on Arrow batches.
    """
    text = F.coalesce(col(c).cast("string"), F.lit(""))
    if engine in ("re", "regex"):
        return text.rlike(pattern)
    if engine == "fnmatch":
        return text.rlike(glob_to_regex(pattern))
    if callable(engine):

        @F.pandas_udf(T.BooleanType())
        def test(candidates: pd.Series) -> pd.Series:
            return candidates.map(lambda c: bool(engine(c, pattern))).astype(bool)

        return test(text)
    raise TypeError("engine must be 're', 'fnmatch' or a function")


def full_score(a: str, b: str) -> int:
    """Similarity of two whole strings, 0 to 100."""
    if not a or not b:
        return 0
    if a == b:
        return 100
    return round(100 * SequenceMatcher(None, a, b, autojunk=False).ratio())


def partial_score(a: str, b: str) -> int:
    """Similarity of the shorter string to its best window in the longer one, 0 to 100."""
    if not a or not b:
        return 0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 100
    blocks = SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()
    starts = {max(block.b - block.a, 0) for block in blocks}
    best = 0.0
    for start in starts:
        window = long[start : start + len(short)]
        best = max(best, SequenceMatcher(None, short, window, autojunk=False).ratio())
        if best > 0.995:
            return 100
    return round(100 * best)


def trigrams(c: Column) -> Column:
    """Different runs of three letters of a text."""
    starts = F.when(F.length(c) > 2, F.sequence(F.lit(1), F.length(c) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(c, i, F.lit(3))))


def split_query(name: str) -> tuple[str, str | None]:
    """``"name, state"`` -> lower-cased name and state; more than two parts are an error."""
    parts = name.split(",")
    if len(parts) > 2:
        raise ValueError(f"expected 'name' or 'name, state', got {name!r}")
    state = parts[1].strip().lower() if len(parts) == 2 else None
    return parts[0].strip().lower(), state


def best_name(names: list[str], wanted: str) -> int:
    """Position of the best match in a short list of names (layers, levels)."""
    name, state = split_query(wanted)
    pool = [i for i, n in enumerate(names) if state is None or n.lower().endswith(state)]
    if not pool:
        raise ValueError(f"no name in {names} matches {wanted!r}")
    rank = lambda i: (partial_score(name, names[i].lower()), full_score(name, names[i].lower()), -i)
    return max(pool, key=rank)


def score_columns(target: Column, name: str) -> Column:
    """Struct of partial and full score of each target against one fixed name."""
    schema = T.StructType(
        [T.StructField("score", T.IntegerType()), T.StructField("score2", T.IntegerType())]
    )

    @F.pandas_udf(schema)
    def scores(targets: pd.Series) -> pd.DataFrame:
        lowered = targets.fillna("").str.lower()
        return pd.DataFrame(
            {
                "score": lowered.map(lambda t: partial_score(name, t)).astype("int32"),
                "score2": lowered.map(lambda t: full_score(name, t)).astype("int32"),
            }
        )

    return scores(target)
