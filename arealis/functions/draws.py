"""Reproducible normal draws that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13
_SPAN = float(16**_DIGITS)


def _uniform(digest: Column, start: int) -> Column:
    number = F.conv(F.substring(digest, start, _DIGITS), 16, 10).cast("double")
    return number / F.lit(_SPAN)


def draw_digest(seed: int, *parts: Column) -> Column:
    """Hash of the seed and the key of a draw; one digest yields both uniforms."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def normal_from_digest(digest: Column) -> Column:
    """Standard normal value by the Box-Muller formula."""
    first, second = _uniform(digest, 1), _uniform(digest, 1 + _DIGITS)
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - first))
    return radius * F.cos(F.lit(2.0 * math.pi) * second)
