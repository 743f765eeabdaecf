"""Margins of error from replicate estimates.

Long form: one row per area and variable, ``(geoid, variable, est, moe, se, reps)`` with
``reps array<double>``. Shuffles move one row per area and variable, never one per
replicate; the replicates are unfolded only after rows of an area are together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions import ids
from arealis.functions.numbers import (
    REPLICATE_FACTOR,
    REPLICATES,
    Z_PUBLISHED,
    band_k,
    infinite_to,
    nan_to_null,
)

Function = Callable[[dict[str, Column]], Column]


# --- variance of given replicates -------------------------------------------------------


def replicate_moe(est: Column, reps: Column) -> Column:
    """1.645 · √(4/80 · Σ(replicate − estimate)²); missing replicates are skipped."""
    squares = F.aggregate(
        reps,
        F.lit(0.0),
        lambda acc, r: acc + F.coalesce((r - est) * (r - est), F.lit(0.0)),
    )
    return F.lit(Z_PUBLISHED) * F.sqrt(F.lit(REPLICATE_FACTOR) * squares)


def all_equal(reps: Column) -> Column:
    """Do the non-missing replicates hold exactly one distinct value?"""
    present = F.filter(reps, lambda r: r.isNotNull())
    return (F.size(present) > 0) & (F.array_min(present) == F.array_max(present))


def collapse(df: DataFrame, by: Sequence[str | Column], n: int = REPLICATES) -> DataFrame:
    """Sum estimates and each replicate over the rows of a key (for example a parent area).

    The sums are plain partial aggregates: a key with very many rows is reduced before
    the shuffle, and the replicates are put back into one array after it. An array of another
    length than ``n`` is an error, whichever of the columns are used.
    """
    known = f"coalesce(size(reps) = {n}, true)"
    odd = f"raise_error(concat('expected {n} replicates, found ', size(reps)))"
    sums = [F.expr(f"sum(get(reps, {i})) AS r{i}") for i in range(1, n)]
    keys = [k if isinstance(k, Column) else F.col(k) for k in by]
    checked = [F.expr(f"sum(if({known}, {c}, {odd}))").alias(a) for c, a in (("est", "est"), ("get(reps, 0)", "r0"))]
    wide = df.groupBy(*keys).agg(*checked, *sums)
    names = wide.columns[: len(keys)]
    return wide.select(*names, "est", F.array(*[f"r{i}" for i in range(n)]).alias("reps"))


# --- any function of several variables -----------------------------------------------------


def variables_side_by_side(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row per area; a struct column ``(est, reps)`` for each named variable.

    A variable the area lacks is missing in the estimate and in all replicates. Arrays
    are aggregated by sorting, and an area has one row per variable, so there is nothing
    to reduce before the shuffle: the rows are sorted once, after it.
    """
    missing = F.struct(
        F.lit(None).cast("double").alias("est"),
        F.array_repeat(F.lit(None).cast("double"), REPLICATES).alias("reps"),
    )
    cell = F.struct(F.col("est").cast("double").alias("est"), "reps")
    picked = [
        F.coalesce(F.max(F.when(F.col("variable") == v, cell)), missing).alias(v)
        for v in variables
    ]
    together = df.where(F.col("variable").isin(*variables)).repartition("geoid")
    return together.groupBy("geoid").agg(*picked)


def function_rows(df: DataFrame, variables: Sequence[str], func: Function) -> DataFrame:
    """``func`` on the estimate and on every replicate: ``(geoid, est, rep, value)``.

    ``func`` maps ``{variable: Column}`` to one Column, evaluated inside the JVM.
    Infinite results become 0.
    """
    wide = variables_side_by_side(df, variables)
    est = func({v: F.col(f"`{v}`.est") for v in variables})
    zipped = F.arrays_zip(*[F.col(f"`{v}`.reps").alias(f"v{i}") for i, v in enumerate(variables)])
    zipped = zipped.cast(
        "array<struct<" + ",".join(f"v{i}:double" for i in range(len(variables))) + ">>"
    )
    rows = wide.select("geoid", _clean(est).alias("est"), F.posexplode(zipped).alias("rep", "v"))
    value = func({v: F.col(f"v.v{i}") for i, v in enumerate(variables)})
    return rows.select("geoid", "est", "rep", _clean(value).alias("value"))


def function_rows_pandas(
    df: DataFrame, variables: Sequence[str], func: Callable[..., pd.Series], **params
) -> DataFrame:
    """As :func:`function_rows` for a pandas function ``func(ests, **params) -> Series``.

    The function sees a batch of areas with one column per variable, once for the
    estimates and once per replicate, so its value for an area must depend on that area
    alone. To combine areas, call :func:`collapse` first.
    """
    wide = variables_side_by_side(df, variables).select(
        "geoid",
        *[F.col(f"`{v}`.est").alias(f"e{i}") for i, v in enumerate(variables)],
        *[F.col(f"`{v}`.reps").alias(f"r{i}") for i, v in enumerate(variables)],
    )
    names = list(variables)

    def run(batches):
        for pdf in batches:
            index = pd.Index(pdf["geoid"], name="geoid")
            table = pd.DataFrame({v: pdf[f"e{i}"].to_numpy() for i, v in enumerate(names)}, index)
            est = np.asarray(func(table, **params), dtype=float)
            stacks = [np.vstack(pdf[f"r{i}"].to_numpy()) for i in range(len(names))]
            for rep in range(stacks[0].shape[1]):
                table = pd.DataFrame({v: stacks[i][:, rep] for i, v in enumerate(names)}, index)
                value = np.asarray(func(table, **params), dtype=float)
                yield pd.DataFrame(
                    {"geoid": pdf["geoid"], "est": est, "rep": rep, "value": value}
                )

    rows = wide.mapInPandas(run, "geoid string, est double, rep int, value double")
    return rows.select("geoid", _clean("est").alias("est"), "rep", _clean("value").alias("value"))


# --- functions over all areas --------------------------------------------------------------


def over_areas(
    df: DataFrame,
    variables: Sequence[str],
    term: Callable[[dict[str, Column], dict[str, Column]], Column],
    totals: dict[str, Function] | None = None,
    finish: Callable[[Column], Column] | None = None,
    by: dict[str, Column] | None = None,
) -> DataFrame:
    """A value over all areas with its margin: ``(*by, est, moe)``.

    The value is given as sums over areas: ``finish`` of the sum of ``term(v, t)``, where ``v`` has an
    area's variables and ``t`` the ``totals``, each the sum of a function of the variables. It is worked
    out for the estimate and for every replicate at once: one pass sums the totals, a second one the
    terms. Both are partial sums by replicate, so no task ever has all areas.

    ``by`` gives columns of the ``geoid`` (say its county) within which the value is taken.
    """
    names, keys = list(variables), list(by or {})
    wide = variables_side_by_side(df, names)
    own = F.struct(*[F.col(f"`{v}`.est").alias(f"v{i}") for i, v in enumerate(names)])
    kind = "array<struct<" + ",".join(f"v{i}:double" for i in range(len(names))) + ">>"
    reps = F.arrays_zip(*[F.col(f"`{v}`.reps").alias(f"v{i}") for i, v in enumerate(names)]).cast(kind)
    versions = F.concat(F.array(own).cast(kind), reps)  # version 0 is the estimate
    rows = wide.select(*(c.alias(k) for k, c in (by or {}).items()), F.posexplode(versions).alias("rep", "v"))
    v = {n: F.col(f"v.v{i}") for i, n in enumerate(names)}
    if totals:
        sums = rows.groupBy(*keys, "rep").agg(*(F.sum(f(v)).alias(f"_t_{n}") for n, f in totals.items()))
        same = [F.col(f"_k{i}").eqNullSafe(F.col(k)) for i, k in enumerate((*keys, "rep"))]
        sums = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate((*keys, "rep"))), *(f"_t_{n}" for n in totals))
        if not keys:  # one row per replicate
            sums = F.broadcast(sums)
        rows = rows.join(sums, same)
    t = {n: F.col(f"_t_{n}") for n in totals or {}}
    value = F.sum(term(v, t))
    values = rows.groupBy(*keys, "rep").agg(_clean(finish(value) if finish else value).alias("value"))
    est = F.max(F.when(F.col("rep") == 0, F.col("value")))
    together = values.groupBy(*keys).agg(est.alias("est"), F.collect_list(F.when(F.col("rep") > 0, F.col("value"))).alias("reps"))
    return together.select(*keys, "est", replicate_moe(F.col("est"), F.col("reps")).alias("moe"))


def _clean(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return infinite_to(nan_to_null(c.cast("double")), 0.0)


def moe_of_rows(rows: DataFrame) -> DataFrame:
    """``(geoid, est, rep, value)`` -> ``(geoid, est, moe, steady)``.

    ``steady`` tells that all replicates have one value. Rows of an area lie together
    after :func:`function_rows`, so this needs no further shuffle.
    """
    diff = F.col("value") - F.col("est")
    spread = F.coalesce(F.sum(diff * diff), F.lit(0.0))
    return rows.groupBy("geoid", "est").agg(
        (F.lit(Z_PUBLISHED) * F.sqrt(F.lit(REPLICATE_FACTOR) * spread)).alias("moe"),
        F.coalesce(F.min("value") == F.max("value"), F.lit(False)).alias("steady"),
    )


def moe_of_arrays(df: DataFrame, keys: Sequence[str] = ("geoid",)) -> DataFrame:
    """As :func:`moe_of_rows` for rows that already hold ``est`` and ``reps``."""
    return df.select(
        *keys,
        "est",
        replicate_moe(F.col("est"), F.col("reps")).alias("moe"),
        all_equal(F.col("reps")).alias("steady"),
    )


# --- zero estimates and missing estimates -----------------------------------------------------


def finish(
    results: DataFrame,
    zeros: str | bool = False,
    rep_nans: bool = True,
    base: DataFrame | None = None,
    state: DataFrame | str | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Rules for zero and missing estimates.

    ``zeros=False``: a zero estimate has no margin. ``'count'`` and ``'prop'``: the margin
    comes from the average weight of the area's state (``weights (fips, avg_weight)``)
    and from the population or denominator (``base (geoid, base)``); ``state`` is one
    code for all areas or a table ``(geoid, fips)``. A missing estimate has no margin and
    becomes 0 unless ``rep_nans`` is false.
    """
    if zeros is False:
        out = results.withColumn("moe", F.when(F.col("est") != 0, F.col("moe")))
    elif str(zeros).lower() in ("count", "prop"):
        if base is None or state is None or weights is None:
            lacking = [n for n, v in (("base", base), ("state", state), ("weights", weights)) if v is None]
            raise ValueError(f"zeros={zeros!r} also takes {', '.join(lacking)}")
        out = _correct_zeros(results, str(zeros).lower(), base, state, weights)
    else:
        raise ValueError("zeros must be 'count', 'prop' or False")
    known = F.col("est").isNotNull()
    est = F.coalesce("est", F.lit(0.0)) if rep_nans else F.col("est")
    return out.select("geoid", est.alias("est"), F.when(known, F.col("moe")).alias("moe"))


def _correct_zeros(
    results: DataFrame, kind: str, base: DataFrame, state: DataFrame | str, weights: DataFrame
) -> DataFrame:
    joined = results.join(base.select("geoid", "base"), "geoid", "left")
    if isinstance(state, str):
        joined = joined.withColumn("fips", F.lit(state))
    else:
        joined = joined.join(state.select("geoid", "fips"), "geoid", "left")
    padded = weights.select(ids.pad_left("fips", 2).alias("fips"), "avg_weight")
    joined = joined.join(padded, "fips", "left")
    weight, size = F.col("avg_weight").cast("double"), F.col("base").cast("double")
    if kind == "count":
        affected = (F.col("est") == 0) | F.col("steady")
        corrected = F.lit(Z_PUBLISHED) * F.sqrt(weight * band_k(size))
    else:
        affected = (F.col("est") == 0) | (F.col("est") == 1)
        share = F.try_divide(weight, size)
        p = F.when(share.isNotNull(), F.least(F.lit(2.3) * share, F.lit(0.5)))
        corrected = F.lit(Z_PUBLISHED) * F.sqrt(p * (F.lit(1.0) - p) * share)
    moe = F.when(affected, corrected).otherwise(F.col("moe"))
    return joined.select("geoid", "est", moe.alias("moe"))


def estimate(
    df: DataFrame,
    variables: Sequence[str],
    func: Function,
    zeros: str | bool = False,
    rep_nans: bool = True,
    base: DataFrame | None = None,
    state: DataFrame | str | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Whole path for a function of Columns: ``(geoid, est, moe)``."""
    results = moe_of_rows(function_rows(df, variables, func))
    return finish(results, zeros, rep_nans, base, state, weights)


def estimate_pandas(
    df: DataFrame,
    variables: Sequence[str],
    func: Callable[..., pd.Series],
    zeros: str | bool = False,
    rep_nans: bool = True,
    base: DataFrame | None = None,
    state: DataFrame | str | None = None,
    weights: DataFrame | None = None,
    **params,
) -> DataFrame:
    """Whole path for a pandas function of one batch of areas."""
    results = moe_of_rows(function_rows_pandas(df, variables, func, **params))
    return finish(results, zeros, rep_nans, base, state, weights)


# --- shaping replicate tables -------------------------------------------------------------


def insert_constant(df: DataFrame, column: DataFrame, name: str, n: int = REPLICATES) -> DataFrame:
    """Add a variable without error to every area: ``column (geoid, value)``.

    The value fills the estimate and all replicates; margin and standard error are 0.
    """
    areas = df.select("geoid").distinct()
    value = F.col("value").cast("double")
    extra = areas.join(column.select("geoid", "value"), "geoid", "left").select(
        "geoid",
        F.lit(name).alias("variable"),
        value.alias("est"),
        F.lit(0.0).alias("moe"),
        F.lit(0.0).alias("se"),
        F.array_repeat(value, n).alias("reps"),
    )
    return df.select("geoid", "variable", "est", "moe", "se", "reps").unionByName(extra)


def select_replicates(
    df: DataFrame, columns: Sequence[str] = (), geos: Sequence[str] = ()
) -> DataFrame:
    """Keep the named variables and areas; an empty list keeps all."""
    if columns:
        df = df.where(F.col("variable").isin(*columns))
    if geos:
        df = df.where(F.col("geoid").isin(*geos))
    return df


def wide_table(df: DataFrame, variables: Sequence[str], category: str = "est") -> DataFrame:
    """One row per area, the variables of one category as columns in the given order."""
    picked = [F.max(F.when(F.col("variable") == v, F.col(category))).alias(v) for v in variables]
    return df.groupBy("geoid").agg(*picked).select("geoid", *variables)


def side_by_side(tables: Sequence[DataFrame]) -> DataFrame:
    """Wide tables next to each other on ``geoid``; an area of any table is kept."""
    out = tables[0]
    for table in tables[1:]:
        out = out.join(table, "geoid", "full_outer")
    return out


def population_of(areas: DataFrame, populations: dict[str, DataFrame]) -> DataFrame:
    """Population of each area as ``(geoid, base)``.

    ``populations`` maps a level type name to its table ``(geoid, population)``. The
    level is read from the id; areas of another level are an error where they occur.
    """
    table = None
    for level, frame in populations.items():
        part = frame.select("geoid", F.col("population").cast("double").alias("base"))
        part = part.withColumn("level", F.lit(level))
        table = part if table is None else table.unionByName(part)
    level = ids.level_type_column(ids.level_code_of("geoid"))
    text = "population tables exist only for: " + ", ".join(sorted(populations))
    checked = F.when(level.isin(*populations), level).otherwise(F.raise_error(F.lit(text)))
    keyed = areas.select("geoid").withColumn("level", checked)
    return keyed.join(table, ["geoid", "level"], "left").select("geoid", "base")
