"""Quality rules with robust multivariate outliers (native).

Counts of every text are taken in one pass over it. Five transformed statistics (length, mean word
length, share of symbols, share of repeated words, share of repeated lines) form a vector; for each language and source the
minimum-covariance-determinant estimate of its centre and scatter is found: from medians and median
deviations, concentration steps re-estimate both on the three quarters of rows that lie nearest,
then on all rows within the 97.5 % ellipsoid. Texts beyond ``CUTOFF`` squared Mahalanobis
distance are rejected, on the side of more symbols or more repetition or at any other extreme.

All steps are aggregates with partial sums, so a language and source that holds most rows is no hot
spot; group estimates are one small row each, copied to ``SALTS`` parts of the group where rows meet them.

Scatter never falls below ``FLOOR`` in any coordinate, so statistics that are the same in all texts
of a group (no symbols at all) stay usable and small departures from them are no outliers. Each floor lets
its statistic pass ``CUTOFF`` by itself: where a group has none, 15 % repeated words or 26 % repeated lines do.

Defined results: a null or empty text has no words and fails the base rules; rows that fail the base
rules are left out of the estimates; null languages and sources are groups of their own; texts of a group with
fewer than ``LEAST_ROWS`` rows are judged by the estimates over all rows of their language, and those of a
language with fewer by the estimates over all rows of the table; no language counts as one. Windows
are compared by 64-bit hashes of their three words. Repeated rows count each; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import BLANKS, content, documents, land

LEAST_WORDS = 50
REPEATED_PERCENT = 50
#: Share of rows that the concentration steps keep.
NEAREST = 0.75
STEPS = 3
LEAST_ROWS = 50
CUTOFF = 30.0
FLOOR = (0.5, 0.1, 0.35, 0.5)
#: The same for the share of repeated lines, the last coordinate.
LINE_FLOOR = 0.6
#: Group of all rows; the others are JSON objects.
TABLE = "table"
#: Parts into which the rows of a group are dealt where they meet its estimates.
SALTS = 32
_INSIDE = {  # quantiles of chi-square by degrees of freedom
    4: {0.75: 5.385269, 0.975: 11.143287},
    5: {0.75: 6.625680, 0.975: 12.832502},
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a three-word window found more than once."""

    def marked(windows: Column) -> Column:
        order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(rows: Column) -> Column:
            twice = F.filter(
                F.transform(
                    rows,
                    lambda r, j: F.when(
                        ((j > 0) & (F.get(rows, j - 1)["h"] == r["h"])) | F.coalesce(F.get(rows, j + 1)["h"] == r["h"], F.lit(False)),
                        r["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(order, covered))

    def windows(n: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        )

    return F.when(F.size(words) < 4, 0).otherwise(let(windows(F.size(words)), marked))


def counts(text: Column) -> Column:
    """n_words, word_chars, n_symbols, lines (n, kinds: different ones), n_repeat_words of a text."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("kinds"))).alias("lines"),
            _repeated(w).cast("long").alias("n_repeat_words"),
        ),
    )


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / words),
        F.log1p(100 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p(100 * F.col("n_repeat_words") / words),
        F.log1p(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
    ]


def _size(rows: DataFrame) -> int:
    """Number of coordinates x_0, x_1, … or of centres m_0, m_1, …"""
    return sum(c[:2] in ("x_", "m_") and c[2:].isdigit() for c in rows.columns)


def _factor(moments: DataFrame, scale: float) -> DataFrame:
    """Cholesky factor of the floored, scaled scatter: columns l_ij beside the centre m_i."""
    out, size = moments, _size(moments)
    for j in range(size):
        done = sum((F.col(f"l_{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        low = F.lit((*FLOOR, LINE_FLOOR)[j] ** 2)
        out = out.withColumn(f"l_{j}{j}", F.sqrt(F.greatest(F.col(f"c_{j}{j}") * scale + low - done, low / 100)))
        for i in range(j + 1, size):
            done = sum((F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l_{i}{j}", (F.col(f"c_{j}{i}") * scale - done) / F.col(f"l_{j}{j}"))
    keep = [f"m_{i}" for i in range(size)] + [f"l_{i}{j}" for i in range(size) for j in range(i + 1)]
    return land(out.select("group", "rows", *keep), "scatter")


def _meeting(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the estimates of their group, which are copied to each part of it."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).alias("salt")
    copies = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.select("*", salt).join(copies, ["group", "salt"], how).drop("salt")


def _distance(rows: DataFrame, factor: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2``; null where the group has no estimate."""
    out, size = _meeting(rows, factor, "left"), _size(rows)
    for i in range(size):
        done = sum((F.col(f"l_{i}{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y_{i}", (F.col(f"x_{i}") - F.col(f"m_{i}") - done) / F.col(f"l_{i}{i}"))
    return out.withColumn("d2", sum((F.col(f"y_{i}") ** 2 for i in range(size)), F.lit(0.0))).select(*rows.columns, "d2")


def _moments(rows: DataFrame) -> DataFrame:
    size = _size(rows)
    return rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.avg(f"x_{i}").alias(f"m_{i}") for i in range(size)),
        *(F.covar_pop(f"x_{i}", f"x_{j}").alias(f"c_{i}{j}") for i in range(size) for j in range(i, size)),
    )


def _consistency(share: float, size: int) -> float:
    """What makes the scatter of the nearest ``share`` of normal rows that of all of them."""
    x = _INSIDE[size][share] / 2
    return share / (share - math.exp(-x) * x ** (size / 2) / math.gamma(size / 2 + 1))


def robust_scatter(rows: DataFrame) -> DataFrame:
    """Centre and scatter of each ``group`` of ``rows`` (group, x_0, x_1, …)."""
    size = _size(rows)
    middle = land(
        rows.groupBy("group").agg(
            F.count(F.lit(1)).alias("rows"), *(F.percentile_approx(f"x_{i}", 0.5).alias(f"m_{i}") for i in range(size))
        ),
        "medians",
    )
    spread = (
        _meeting(rows, middle)
        .groupBy("group")
        .agg(*(F.percentile_approx(F.abs(F.col(f"x_{i}") - F.col(f"m_{i}")), 0.5).alias(f"s_{i}") for i in range(size)))
    )
    first = middle.join(spread, "group")
    for i in range(size):
        for j in range(i, size):
            value = (1.4826 * F.col(f"s_{i}")) ** 2 if i == j else F.lit(0.0)
            first = first.withColumn(f"c_{i}{j}", value)
    factor = _factor(first, 1.0)
    for _ in range(STEPS):
        near = _distance(rows, factor)
        edge = near.groupBy("group").agg(F.percentile_approx("d2", NEAREST).alias("edge"))
        factor = _factor(_moments(_meeting(near, edge).where("d2 <= edge")), _consistency(NEAREST, size))
    inside = _distance(rows, factor).where(F.col("d2") <= _INSIDE[size][0.975])
    return _factor(_moments(inside), _consistency(0.975, size))


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, the counts, base_failed, d2 and kept."""
    rows = land(
        docs.select(
            F.col(f"`{id_column}`").alias("id"),
            F.col("lang").cast("string").alias("lang"),
            F.col("source").cast("string").alias("source"),
            counts(content(text_column)).alias("n"),
        ).select(
            "id", "lang", "source", "n.n_words", "n.word_chars", "n.n_symbols", F.col("n.lines.n").alias("n_lines"),
            (F.col("n.lines.n") - F.col("n.lines.kinds")).cast("long").alias("n_dup_lines"), "n.n_repeat_words",
        ),
        "counts",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    rows = rows.withColumn("base_failed", failed).select(
        "*", *(x.alias(f"x_{i}") for i, x in enumerate(_vector()))
    )
    sizes = land(rows.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("size")), "sizes")
    langs = sizes.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.min("size").alias("smallest"))
    same_lang = F.col("r.lang").eqNullSafe(F.col("l.lang"))
    rows = (
        rows.alias("r")
        .join(sizes.alias("s"), F.col("r.lang").eqNullSafe(F.col("s.lang")) & F.col("r.source").eqNullSafe(F.col("s.source")), "left")
        .join(langs.alias("l"), same_lang, "left")
        .select("r.*", "size", "lang_size", "smallest")
    )
    # the groups that a row is in; it is judged by the first one that is large enough
    own = F.to_json(F.struct("lang", F.struct(F.col("source").alias("is")).alias("source")))
    language = F.to_json(F.struct("lang"))
    judged_by_own = F.coalesce(F.col("size") >= LEAST_ROWS, F.lit(False))
    judged_by_language = F.coalesce(F.col("lang_size") >= LEAST_ROWS, F.lit(False))
    group = F.when(judged_by_own, own).when(judged_by_language, language).otherwise(F.lit(TABLE))
    rows = land(rows.withColumn("group", group), "vectors")
    rare = bool(langs.where(f"lang_size < {LEAST_ROWS}").take(1))
    groups = F.array_compact(
        F.array(
            F.when(judged_by_own, own),
            F.when(judged_by_language & (F.col("smallest") < LEAST_ROWS), language),
            F.when(F.lit(rare), F.lit(TABLE)),
        )
    )
    vector = [f"x_{i}" for i in range(len(_vector()))]
    estimate = robust_scatter(rows.where("not base_failed").select(F.explode(groups).alias("group"), *vector))
    found = _distance(rows, estimate)
    return found.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)).alias("kept"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).drop("d2").withColumnRenamed("id", "doc_id")


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLE: dict[str, str] = {}
