"""Margins of error by closed formulas: sums, ratios, proportions.

Estimates and margins are paired on the variable, so the zero rule always applies.
A zero denominator gives NULL for both the estimate and the margin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.numbers import col


def sum_moe_aggregates(est: Column | str = "est", moe: Column | str = "moe") -> list[Column]:
    """Aggregates ``est`` and ``moe`` of a sum.

    Margins add in squares; of all cells whose estimate is zero only the largest margin
    counts. A missing estimate adds nothing to the sum, its margin still counts.
    """
    est, moe = col(est), col(moe)
    is_zero = est.eqNullSafe(F.lit(0.0))
    squares = F.sum(F.when(is_zero, F.lit(0.0)).otherwise(moe * moe))
    largest = F.coalesce(F.max(F.when(is_zero, moe)), F.lit(0.0))
    return [
        F.coalesce(F.sum(est), F.lit(0.0)).alias("est"),
        F.sqrt(F.coalesce(squares, F.lit(0.0)) + largest * largest).alias("moe"),
    ]


def sum_with_moe(df: DataFrame, by: list[str], est: str = "est", moe: str = "moe") -> DataFrame:
    """Sum of long rows ``(…, est, moe)`` per key, over variables or over areas."""
    return df.groupBy(*by).agg(*sum_moe_aggregates(est, moe))


def ratio(
    num: Column | str, den: Column | str, num_moe: Column | str, den_moe: Column | str
) -> tuple[Column, Column]:
    """Estimate and margin of a ratio (numerator outside the denominator)."""
    num, den, num_moe, den_moe = map(col, (num, den, num_moe, den_moe))
    est = F.try_divide(num.cast("double"), den)
    root = F.sqrt(num_moe * num_moe + est * est * den_moe * den_moe)
    return est, F.try_divide(root, den)


def proportion(
    num: Column | str, den: Column | str, num_moe: Column | str, den_moe: Column | str
) -> tuple[Column, Column]:
    """Estimate and margin of a proportion (numerator inside the denominator).

    Where the difference under the root is negative or zero, the ratio formula is taken.
    """
    est, fallback = ratio(num, den, num_moe, den_moe)
    num_moe, den_moe, den = col(num_moe), col(den_moe), col(den)
    square = num_moe * num_moe - est * est * den_moe * den_moe
    moe = F.when(square > 0, F.try_divide(F.sqrt(square), den)).otherwise(fallback)
    return est, moe


def with_ratio(df: DataFrame, num: str, den: str, num_moe: str, den_moe: str) -> DataFrame:
    est, moe = ratio(num, den, num_moe, den_moe)
    return df.withColumn("est", est).withColumn("moe", moe)


def with_proportion(df: DataFrame, num: str, den: str, num_moe: str, den_moe: str) -> DataFrame:
    est, moe = proportion(num, den, num_moe, den_moe)
    return df.withColumn("est", est).withColumn("moe", moe)
