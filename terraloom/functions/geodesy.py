"""WGS84 geodesy as columns of doubles."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The WGS84 ellipsoid.
SEMI_MAJOR, FLATTENING = 6378137.0, 1.0 / 298.257223563
ECC2 = FLATTENING * (2 - FLATTENING)
SEMI_MINOR = SEMI_MAJOR * (1 - FLATTENING)
ECC2_SECOND = (SEMI_MAJOR**2 - SEMI_MINOR**2) / SEMI_MINOR**2

Triple = tuple[Column, Column, Column]


def geodetic_to_ecef(lat: Column, lon: Column, alt: Column) -> Triple:
    """Degrees and metres to earth-centred metres."""
    phi, lam = F.radians(lat), F.radians(lon)
    n = F.lit(SEMI_MAJOR) / F.sqrt(1.0 - ECC2 * F.sin(phi) * F.sin(phi))
    return (n + alt) * F.cos(phi) * F.cos(lam), (n + alt) * F.cos(phi) * F.sin(lam), (n * (1 - ECC2) + alt) * F.sin(phi)


def ecef_to_geodetic(x: Column, y: Column, z: Column) -> Triple:
    """One step of Bowring's method: latitude and longitude in degrees, height in metres."""
    p = F.hypot(x, y)
    theta = F.atan2(z * SEMI_MAJOR, p * SEMI_MINOR)
    lat = F.atan2(z + ECC2_SECOND * SEMI_MINOR * F.pow(F.sin(theta), 3), p - ECC2 * SEMI_MAJOR * F.pow(F.cos(theta), 3))
    n = F.lit(SEMI_MAJOR) / F.sqrt(1 - ECC2 * F.pow(F.sin(lat), 2))
    return F.degrees(lat), F.degrees(F.atan2(y, x)), p / F.cos(lat) - n


@dataclass(frozen=True)
class LocalFrame:
    """East, north and up at an origin; its matrix and centre are constants of the plan."""

    lat0: float
    lon0: float
    alt0: float

    @property
    def centre(self) -> tuple[float, float, float]:
        phi, lam = math.radians(self.lat0), math.radians(self.lon0)
        n = SEMI_MAJOR / math.sqrt(1 - ECC2 * math.sin(phi) ** 2)
        return (n + self.alt0) * math.cos(phi) * math.cos(lam), (n + self.alt0) * math.cos(phi) * math.sin(lam), (n * (1 - ECC2) + self.alt0) * math.sin(phi)

    @property
    def axes(self) -> tuple[tuple[float, float, float], ...]:
        """Rows: east, north, up in earth-centred coordinates."""
        phi, lam = math.radians(self.lat0), math.radians(self.lon0)
        return (-math.sin(lam), math.cos(lam), 0.0), (-math.sin(phi) * math.cos(lam), -math.sin(phi) * math.sin(lam), math.cos(phi)), (math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi))

    def from_ecef(self, x: Column, y: Column, z: Column) -> Triple:
        d = [c - o for c, o in zip((x, y, z), self.centre)]
        return tuple(r[0] * d[0] + r[1] * d[1] + r[2] * d[2] for r in self.axes)

    def from_geodetic(self, lat: Column, lon: Column, alt: Column) -> Triple:
        return self.from_ecef(*geodetic_to_ecef(lat, lon, alt))

    def to_geodetic(self, e: Column, n: Column, u: Column) -> Triple:
        a, c = self.axes, self.centre
        return ecef_to_geodetic(*(a[0][i] * e + a[1][i] * n + a[2][i] * u + c[i] for i in range(3)))
