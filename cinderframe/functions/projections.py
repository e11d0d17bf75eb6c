"""Map projections in closed form (Snyder, Map Projections: A Working Manual, 1987), as column expressions in degrees and metres."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS 1980 and WGS 84 agree to the millimetre here.
A, E2 = 6378137.0, 0.0066943800229


def utm_epsg(lon: Column, lat: Column) -> Column:
    """Code of the UTM zone of a place: 326zz north of the equator, 327zz south of it."""
    return F.when(lat >= 0, 32600).otherwise(32700) + F.floor((lon + 180) / 6) + 1


def _q(sin: Column | float) -> Column | float:
    e = math.sqrt(E2)
    log = F.log if isinstance(sin, Column) else math.log
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - log((1 - e * sin) / (1 + e * sin)) / (2 * e))


def albers(lon: Column, lat: Column, lon0: float = -96.0, lat0: float = 23.0, lat1: float = 29.5, lat2: float = 45.5) -> tuple[Column, Column]:
    """Equal-area x and y on the conus Albers cone (EPSG:5070 by default)."""
    s1, s2 = math.sin(math.radians(lat1)), math.sin(math.radians(lat2))
    m1, m2 = (math.cos(math.radians(p)) ** 2 / (1 - E2 * s * s) for p, s in ((lat1, s1), (lat2, s2)))
    n = (m1 - m2) / (_q(s2) - _q(s1))
    c = m1 + n * _q(s1)
    rho0 = A * math.sqrt(c - n * _q(math.sin(math.radians(lat0)))) / n
    rho = A * F.sqrt(c - n * _q(F.sin(F.radians(lat)))) / n
    theta = n * (F.radians(lon) - math.radians(lon0))
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def utm(lon: Column, lat: Column, zone: int | Column, south: bool = False) -> tuple[Column, Column]:
    """Easting and northing by the transverse Mercator series."""
    k0, ep2 = 0.9996, E2 / (1 - E2)
    phi = F.radians(lat)
    n = A / F.sqrt(1 - E2 * F.sin(phi) ** 2)
    t, c = F.tan(phi) ** 2, ep2 * F.cos(phi) ** 2
    a = F.radians(lon - (6 * zone - 183)) * F.cos(phi)
    m = A * ((1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256) * phi - (3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024) * F.sin(2 * phi) + (15 * E2**2 / 256 + 45 * E2**3 / 1024) * F.sin(4 * phi) - (35 * E2**3 / 3072) * F.sin(6 * phi))
    x = k0 * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * a**5 / 120) + 500_000
    y = k0 * (m + n * F.tan(phi) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * a**6 / 720))
    return x, y + (10_000_000 if south else 0)


def utm_inverse(x: Column, y: Column, zone: int | Column, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of a UTM easting and northing."""
    k0, ep2 = 0.9996, E2 / (1 - E2)
    m = (y - (10_000_000 if south else 0)) / k0
    mu = m / (A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256))
    e1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
    phi = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    c, t = ep2 * F.cos(phi) ** 2, F.tan(phi) ** 2
    n = A / F.sqrt(1 - E2 * F.sin(phi) ** 2)
    r = A * (1 - E2) / (1 - E2 * F.sin(phi) ** 2) ** 1.5
    d = (x - 500_000) / (n * k0)
    lat = phi - (n * F.tan(phi) / r) * (d**2 / 2 - (5 + 3 * t + 10 * c - 4 * c**2 - 9 * ep2) * d**4 / 24 + (61 + 90 * t + 298 * c + 45 * t**2 - 252 * ep2 - 3 * c**2) * d**6 / 720)
    lon = (d - (1 + 2 * t + c) * d**3 / 6 + (5 - 2 * c + 28 * t - 3 * c**2 + 8 * ep2 + 24 * t**2) * d**5 / 120) / F.cos(phi)
    return F.degrees(lon) + (6 * zone - 183), F.degrees(lat)
