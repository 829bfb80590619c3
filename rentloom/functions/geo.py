"""Map projection and polygon predicates as column arithmetic."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentloom import fixed_values as fixed
from rentloom.functions.text import code_text, pad_left, parse_number, piece


@dataclass(frozen=True)
class AlbersEqualArea:
    """Ellipsoidal Albers equal-area conic (J. P. Snyder, USGS Professional Paper 1395)."""

    major_axis: float
    eccentricity_squared: float
    parallels: tuple[float, float]
    origin: tuple[float, float]

    def _area(self, sine):
        """Snyder's q for a sine of latitude, as a float or a Column."""
        e = math.sqrt(self.eccentricity_squared)
        log = F.log if isinstance(sine, Column) else math.log
        band = log((1 - e * sine) / (1 + e * sine))
        return (1 - e * e) * (sine / (1 - e * e * sine * sine) - band / (2 * e))

    def _cone(self) -> tuple[float, float, float]:
        def parallel(degrees):
            s, c = math.sin(math.radians(degrees)), math.cos(math.radians(degrees))
            return c * c / (1 - self.eccentricity_squared * s * s), self._area(s)

        (m1, q1), (m2, q2) = map(parallel, self.parallels)
        n = (m1 - m2) / (q2 - q1)
        c = m1 + n * q1
        q0 = self._area(math.sin(math.radians(self.origin[0])))
        return n, c, self.major_axis * math.sqrt(c - n * q0) / n

    def xy(self, lng: Column, lat: Column) -> tuple[Column, Column]:
        """Easting and northing; NULL where a coordinate is missing."""
        n, c, rho0 = self._cone()
        q = self._area(F.sin(F.radians(lat)))
        rho = F.sqrt(F.lit(c) - n * q) * (self.major_axis / n)
        theta = F.radians(lng - self.origin[1]) * n
        return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


_FLAT = 1 / fixed.ALBERS_INVERSE_FLATTENING
CONUS = AlbersEqualArea(
    fixed.ALBERS_MAJOR_AXIS, _FLAT * (2 - _FLAT), fixed.ALBERS_PARALLELS, fixed.ALBERS_ORIGIN
)


def albers_5070(lng: Column, lat: Column) -> tuple[Column, Column]:
    return CONUS.xy(lng, lat)


def project_rings(rings: Column) -> Column:
    """Move every vertex of a polygon from degrees to EPSG:5070 metres."""
    def moved(v):
        x, y = albers_5070(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, moved))


def ring_edges(rings: Column) -> Column:
    """All edges of all rings; rings may or may not repeat their first vertex."""
    def edges(ring):
        def edge(v, i):
            nxt = F.element_at(ring, ((i + 1) % F.size(ring)) + 1)
            return F.struct(v["x"].alias("x1"), v["y"].alias("y1"),
                            nxt["x"].alias("x2"), nxt["y"].alias("y2"))
        return F.transform(ring, edge)

    return F.flatten(F.transform(rings, edges))


def covers(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all edges (holes and parts included); the border belongs to the polygon.

    The cheap comparisons come first: most edges of a list are settled by them.
    """
    def turn(e):
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])

    def touches(e):
        return (
            (F.least(e["y1"], e["y2"]) <= y) & (F.greatest(e["y1"], e["y2"]) >= y)
            & (F.least(e["x1"], e["x2"]) <= x) & (F.greatest(e["x1"], e["x2"]) >= x)
            & (turn(e) == 0)
        )

    def crosses(e):
        upward = e["y2"] > e["y1"]
        return ((e["y1"] > y) != (e["y2"] > y)) & ((turn(e) > 0) == upward)

    odd = F.aggregate(edges, F.lit(False), lambda seen, e: seen != crosses(e))
    return F.exists(edges, touches) | odd


def url_coordinates(url: Column) -> tuple[Column, Column]:
    """Latitude and longitude behind the marker in a map link."""
    pair = piece(url, fixed.URL_COORDINATES, 2, count=2)
    return parse_number(piece(pair, ",", 1)), parse_number(piece(pair, ",", 2))


def url_county(url: Column) -> Column:
    """Five-digit county code behind the marker in a listing link."""
    return pad_left(code_text(parse_number(piece(url, fixed.URL_COUNTY, 2, count=2))), 5, "0")
