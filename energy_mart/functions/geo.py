"""Projected CRTM05 metres to WGS84 degrees, as plain column arithmetic, no Python workers.

Inverse transverse Mercator by the usual series (USGS Professional Paper 1395).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.numbers import lenient_double

# Ellipsoid and CRTM05 projection.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9999
FALSE_EASTING = 500000.0
CENTRAL_MERIDIAN = -84.0
SRID = 5367

_E2 = FLATTENING * (2 - FLATTENING)
_EP2 = _E2 / (1 - _E2)


def _footpoint(mu: Column) -> Column:
    """Latitude whose meridian arc gives the rectifying latitude ``mu``."""
    root = math.sqrt(1 - _E2)
    n = (1 - root) / (1 + root)
    terms = (
        (2, 3 * n / 2 - 27 * n**3 / 32),
        (4, 21 * n**2 / 16 - 55 * n**4 / 32),
        (6, 151 * n**3 / 96),
        (8, 1097 * n**4 / 512),
    )
    out = mu
    for multiple, weight in terms:
        out = out + F.sin(mu * multiple) * weight
    return out


def with_lon_lat(df: DataFrame, easting: str, northing: str, lon: str, lat: str) -> DataFrame:
    """Add (or replace) longitude and latitude in degrees; null or bad input gives null.

    Each stage of the series is a projection of its own: its terms are used many times, and
    one expression would repeat them in the plan.
    """
    arc = SEMI_MAJOR * SCALE * (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256)
    x, mu, foot, sin, t, c, w, d = (F.col(f"__{n}") for n in ("x", "mu", "foot", "sin", "t", "c", "w", "d"))
    cos, tan, d2 = F.col("__cos"), F.col("__tan"), F.col("__d2")
    staged = (
        df.withColumns(
            {
                "__x": lenient_double(F.col(easting)),
                "__mu": lenient_double(F.col(northing)) / F.lit(arc),
            }
        )
        .withColumn("__foot", _footpoint(mu))
        .withColumns({"__sin": F.sin(foot), "__cos": F.cos(foot), "__tan": F.tan(foot)})
        .withColumns({"__t": tan * tan, "__c": cos * cos * _EP2, "__w": F.lit(1.0) - sin * sin * _E2})
        .withColumn("__d", (x - FALSE_EASTING) * F.sqrt(w) / F.lit(SEMI_MAJOR * SCALE))
        .withColumn("__d2", d * d)
    )
    lat4 = t * 3 + c * 10 - c * c * 4 + (5 - 9 * _EP2)
    lat6 = t * 90 + c * 298 + t * t * 45 - c * c * 3 + (61 - 252 * _EP2)
    drop = tan * w / F.lit(1 - _E2) * d2 * (d2 * (d2 * lat6 / 720 - lat4 / 24) + 0.5)
    lon3 = t * 2 + c + 1
    lon5 = t * 28 - c * 2 - c * c * 3 + t * t * 24 + (5 + 8 * _EP2)
    east = d * (d2 * (d2 * lon5 / 120 - lon3 / 6) + 1) / cos
    placed = staged.withColumns(
        {lon: F.degrees(east) + CENTRAL_MERIDIAN, lat: F.degrees(foot - drop)}
    )
    return placed.drop(*[c for c in placed.columns if c.startswith("__") and c not in df.columns])
