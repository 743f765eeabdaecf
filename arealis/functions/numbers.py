"""Numeric helpers: division, missing values, constants of the error formulas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The normal quantile used for published margins (three decimals) and the
# one used for simulated margins (full precision), number of replicates in the factor.
Z_PUBLISHED = 1.645
Z_SIMULATED = 1.6448536269514722
REPLICATES = 80
REPLICATE_FACTOR = 4.0 / 80.0

# Codes that stand for a missing estimate.
MISSING_CODES = (-999999999, -888888888, -666666666, -555555555, -333333333, -222222222)

# Highest population of a band and its k, then k above the last band.
POPULATION_BANDS = ((4999, 4), (9999, 8), (19999, 10), (29999, 14), (49999, 18))
POPULATION_TOP_K = 22

_INF = float("inf")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def divide(num: Column, den: Column) -> Column:
    """Floating-point division: x/0 is an infinity, 0/0 is NULL, and nothing raises.

    User functions over replicates or simulations should use this in place of ``/``.
    """
    num, den = col(num).cast("double"), col(den).cast("double")
    at_zero = F.when(num > 0, F.lit(_INF)).when(num < 0, F.lit(-_INF))
    return F.when(den == 0, at_zero).otherwise(F.try_divide(num, den))


def is_infinite(c: Column) -> Column:
    return (c == F.lit(_INF)) | (c == F.lit(-_INF))


def infinite_to(c: Column, value: float) -> Column:
    return F.when(is_infinite(c), F.lit(value)).otherwise(c)


def finite_or(c: Column, value: float) -> Column:
    """Replace NULL, NaN and infinities by a number."""
    bad = c.isNull() | F.isnan(c) | is_infinite(c)
    return F.when(bad, F.lit(float(value))).otherwise(c)


def missing_to_null(c: Column, codes: Iterable[float] = MISSING_CODES) -> Column:
    return F.when(c.isin(*codes), F.lit(None)).otherwise(c)


def standard_error(moe: Column) -> Column:
    return moe / F.lit(Z_PUBLISHED)


def band_k(population: Column) -> Column:
    """k of the population band; NULL for a missing population."""
    out = None
    for top, k in POPULATION_BANDS:
        cond = population <= top
        out = F.when(cond, k) if out is None else out.when(cond, k)
    return out.when(population.isNotNull(), POPULATION_TOP_K)
