"""Distances on the globe and the grid used to find near points."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.values import as_col

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km of two points given in degrees."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dp, dl = p2 - p1, F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Point on the unit sphere. Straight-line distance orders points as the great circle does."""
    p, m = F.radians(as_col(lat)), F.radians(as_col(lon))
    return F.cos(p) * F.cos(m), F.cos(p) * F.sin(m), F.sin(p)


def apart_km(lat, lon, south, north, west, east) -> Column:
    """A distance in km that a point is at least away from everything in a box of latitudes and longitudes.

    The box must not cross the date line; the point may lie on the other side of it. A hair is taken off, so that
    rounding keeps the bound below the distances computed.
    """
    lat, lon, south, north, west, east = map(as_col, (lat, lon, south, north, west, east))
    up = F.radians(F.greatest(south - lat, lat - north, F.lit(0.0)))
    gap = F.greatest(west - lon, lon - east, F.lit(0.0))
    around = F.radians(F.least(gap, F.greatest(360.0 - (F.greatest(east, lon) - F.least(west, lon)), F.lit(0.0))))
    narrow = F.cos(F.radians(F.greatest(F.abs(south), F.abs(north)))) * F.cos(F.radians(lat))
    h = F.pow(F.sin(up / 2), 2) + F.greatest(narrow, F.lit(0.0)) * F.pow(F.sin(around / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (1 - 1e-9) - 1e-6


class Grid:
    """Latitude bands cut into cells at least ``radius_km`` wide and high.

    Two points within the radius lie in the same or in neighbouring bands, and in the other band's
    ring at most one cell apart, because a ring's cell width is taken where its neighbourhood is
    narrowest. The number of cells of a ring divides 360 degrees, so the date line needs no care.
    """

    def __init__(self, radius_km: float):
        # A hair wider than the radius: rounding must not push a pair out of the neighbourhood.
        self.step = math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + 1e-9)
        self.sin_half = math.sin(radius_km / (2 * EARTH_RADIUS_KM)) * (1 + 1e-9)

    def band(self, lat) -> Column:
        return F.floor(as_col(lat) / self.step).cast("int")

    def _ring_size(self, band: Column) -> Column:
        far = F.greatest(F.abs(band - 1), F.abs(band + 2)) * self.step
        narrow = F.cos(F.radians(F.least(far, F.lit(90.0))))
        wide = F.when(
            narrow > self.sin_half, 2 * F.degrees(F.asin(F.lit(self.sin_half) / narrow))
        ).otherwise(360.0)
        return F.greatest(F.floor(F.lit(360.0) / wide), F.lit(1)).cast("int")

    def slot(self, band: Column, lon) -> Column:
        """Cell index of a longitude inside the ring of ``band``."""
        n = self._ring_size(band)
        return F.pmod(F.floor((as_col(lon) + 180.0) * n / 360.0).cast("int"), n)

    def cell(self, lat, lon) -> Column:
        b = self.band(lat)
        return F.struct(b.alias("band"), self.slot(b, lon).alias("slot"))

    def _ring(self, lat, lon, up: int) -> Column:
        b = self.band(lat) + up
        n, s = self._ring_size(b), self.slot(b, lon)
        near = F.array(*[F.pmod(s + d, n) for d in (-1, 0, 1)])
        return F.transform(
            F.array_distinct(near), lambda x: F.struct(b.alias("band"), x.alias("slot"))
        )

    def forward_cells(self, lat, lon) -> Column:
        """Cells of the point's own band and of the next one that can hold a partner.

        Looking only forward finds each pair of different bands once.
        """
        return F.concat(self._ring(lat, lon, 0), self._ring(lat, lon, 1))

    def touching_cells(self, lat, lon) -> Column:
        """All cells that can hold a point within the radius."""
        return F.concat(*[self._ring(lat, lon, up) for up in (-1, 0, 1)])
