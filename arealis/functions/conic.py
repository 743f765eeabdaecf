"""Conic projections with two standard parallels on an ellipsoid: Albers (equal area) and Lambert (conformal).

The constants of a projection are worked out once; points are column expressions in closed form. Back from
the plane the latitude comes from its series, sharpened by one step, which leaves less than a micrometre.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass(frozen=True)
class Conic:
    """``kind`` is ``albers`` or ``lambert``; angles in degrees, lengths in the unit of ``radius``."""

    kind: str
    first: float
    second: float
    origin: float
    meridian: float
    x0: float = 0.0
    y0: float = 0.0
    radius: float = 6378137.0
    e2: float = 0.00669438002290

    def __post_init__(self):
        if self.kind not in ("albers", "lambert"):
            raise ValueError("kind must be 'albers' or 'lambert'")
        if abs(self.first + self.second) < 1e-9:
            raise ValueError("the standard parallels must not lie opposite to each other")

    # --- the same functions of a latitude, for constants and for columns -----------------------

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - self.e2 * math.sin(lat) ** 2)

    def _q(self, lat: float) -> float:
        s = math.sin(lat)
        return (1 - self.e2) * (s / (1 - self.e2 * s * s) - math.log((1 - self.e * s) / (1 + self.e * s)) / (2 * self.e))

    def _t(self, lat: float) -> float:
        s = math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - self.e * s) / (1 + self.e * s)) ** (self.e / 2)

    @cached_property
    def constants(self) -> tuple[float, float, float]:
        """n, c (the scale of the radius) and the radius at the origin."""
        one, two, origin = (math.radians(x) for x in (self.first, self.second, self.origin))
        same = abs(one - two) < 1e-12
        if self.kind == "albers":
            n = math.sin(one) if same else (self._m(one) ** 2 - self._m(two) ** 2) / (self._q(two) - self._q(one))
            c = self._m(one) ** 2 + n * self._q(one)
            return n, c, self.radius * math.sqrt(c - n * self._q(origin)) / n
        n = math.sin(one) if same else (math.log(self._m(one)) - math.log(self._m(two))) / (math.log(self._t(one)) - math.log(self._t(two)))
        c = self._m(one) / (n * self._t(one) ** n)
        return n, c, self.radius * c * self._t(origin) ** n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Plane coordinates of longitude and latitude in degrees."""
        n, c, rho0 = self.constants
        s = F.sin(F.radians(lat))
        ratio = (F.lit(1.0) - F.lit(self.e) * s) / (F.lit(1.0) + F.lit(self.e) * s)
        if self.kind == "albers":
            q = F.lit(1 - self.e2) * (s / (F.lit(1.0) - F.lit(self.e2) * s * s) - F.ln(ratio) / F.lit(2 * self.e))
            rho = F.lit(self.radius / n) * F.sqrt(F.lit(c) - F.lit(n) * q)
        else:
            t = F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2) / F.pow(ratio, F.lit(self.e / 2))
            rho = F.lit(self.radius * c) * F.pow(t, F.lit(n))
        theta = F.lit(n) * F.radians(lon - F.lit(self.meridian))
        return rho * F.sin(theta) + F.lit(self.x0), F.lit(rho0 + self.y0) - rho * F.cos(theta)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude and latitude in degrees of plane coordinates."""
        n, c, rho0 = self.constants
        sign = math.copysign(1.0, n)
        right, up = x - F.lit(self.x0), F.lit(rho0 + self.y0) - y
        lon = F.lit(self.meridian) + F.degrees(F.atan2(F.lit(sign) * right, F.lit(sign) * up) / F.lit(n))
        rho = F.lit(sign) * F.sqrt(right * right + up * up)
        lat = let(rho, self._albers_latitude if self.kind == "albers" else self._lambert_latitude)
        return lon, F.degrees(lat)

    def _albers_latitude(self, rho: Column) -> Column:
        n, c, _ = self.constants
        e2, pole = self.e2, self._q(math.pi / 2)
        q = (F.lit(c) - rho * rho * F.lit(n * n / self.radius**2)) / F.lit(n)
        series = (
            e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040,
            23 * e2**2 / 360 + 251 * e2**3 / 3780,
            761 * e2**3 / 45360,
        )

        def sharper(q: Column) -> Column:
            beta = F.asin(F.greatest(F.least(q / F.lit(pole), F.lit(1.0)), F.lit(-1.0)))
            rough = let(beta, lambda b: sum((F.lit(a) * F.sin(F.lit(2.0 * i) * b) for i, a in enumerate(series, 1)), b))

            def step(lat: Column) -> Column:
                s = F.sin(lat)
                rest = q / F.lit(1 - e2) - s / (F.lit(1.0) - F.lit(e2) * s * s)
                rest = rest + F.ln((F.lit(1.0) - F.lit(self.e) * s) / (F.lit(1.0) + F.lit(self.e) * s)) / F.lit(2 * self.e)
                flat = F.pow(F.lit(1.0) - F.lit(e2) * s * s, F.lit(2.0))
                return lat + F.coalesce(F.try_divide(flat * rest, F.lit(2.0) * F.cos(lat)), F.lit(0.0))

            return let(rough, step)

        return let(q, sharper)

    def _lambert_latitude(self, rho: Column) -> Column:
        n, c, _ = self.constants
        e2 = self.e2
        series = (
            e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360,
            7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520,
            7 * e2**3 / 120 + 81 * e2**4 / 1120,
            4279 * e2**4 / 161280,
        )

        def sharper(t: Column) -> Column:
            chi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
            rough = let(chi, lambda b: sum((F.lit(a) * F.sin(F.lit(2.0 * i) * b) for i, a in enumerate(series, 1)), b))

            def step(lat: Column) -> Column:
                s = F.lit(self.e) * F.sin(lat)
                return F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * F.pow((F.lit(1.0) - s) / (F.lit(1.0) + s), F.lit(self.e / 2)))

            return let(rough, step)

        return let(F.pow(rho / F.lit(self.radius * c), F.lit(1 / n)), sharper)


# Conic systems by their number.
SYSTEMS = {
    5070: Conic("albers", 29.5, 45.5, 23.0, -96.0),
    102003: Conic("albers", 29.5, 45.5, 37.5, -96.0),
    102004: Conic("lambert", 33.0, 45.0, 39.0, -96.0),
}
