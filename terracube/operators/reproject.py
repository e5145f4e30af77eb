"""Reprojection of swath or map coordinates to a latitude/longitude grid (first step of C5).

A projected product has per-pixel coordinates ``x, y`` in metres; its latitudes and
longitudes are not separable, so no axis tables exist. A pixel is divided into
``sub x sub`` points of equal area in the projected plane, each point is put through the
inverse projection (column arithmetic, evaluated in the scan's stage) and falls into one
target cell. The points per pixel and cell are the weights: a cell's value is the mean of
the pixels that reach into it, weighted by the area they have there, over those that have
a value. Weights come from the distinct pixels, once for all time steps; AQE measures the
table before it meets the cube.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Radius of the authalic sphere of global sinusoidal grids, and the ellipsoid
# and orbit of geostationary imagers (metres).
SPHERE = 6371007.181
EQUATOR, POLE, ORBIT = 6378169.0, 6356583.8, 42164000.0


@dataclass(frozen=True)
class Projection:
    """``inverse(x, y)`` gives latitude and longitude in degrees, NULL off the map; ``dx, dy`` are a pixel's sides."""

    inverse: Callable[[Column, Column], tuple[Column, Column]]
    dx: float
    dy: float


def sinusoidal(dx: float, dy: float, lon_0: float = 0.0, radius: float = SPHERE) -> Projection:
    """Equal-area map: ``lat = y / R``, ``lon = lon_0 + x / (R cos lat)``; NULL beyond the poles or the date line."""
    def inverse(x: Column, y: Column) -> tuple[Column, Column]:
        lat = y / F.lit(radius)
        lon = x / (F.lit(radius) * F.cos(lat))
        on_map = (F.abs(lat) < F.pi() / 2) & (F.abs(lon) <= F.pi())
        return F.when(on_map, F.degrees(lat)), F.when(on_map, F.degrees(lon) + F.lit(lon_0))

    return Projection(inverse, dx, dy)


def geostationary(dx: float, dy: float, lon_0: float = 0.0, orbit: float = ORBIT) -> Projection:
    """View from above the equator; ``x, y`` are scan angles times the height above ground. A line of
    sight that misses the ellipsoid (off the disc) is NULL."""
    height, q = orbit - EQUATOR, (EQUATOR / POLE) ** 2

    def inverse(x: Column, y: Column) -> tuple[Column, Column]:
        a, b = x / F.lit(height), y / F.lit(height)
        bulge = F.cos(b) * F.cos(b) + F.lit(q) * F.sin(b) * F.sin(b)
        ahead = F.lit(orbit) * F.cos(a) * F.cos(b)
        inside = ahead * ahead - bulge * F.lit(orbit**2 - EQUATOR**2)
        far = (ahead - F.sqrt(inside)) / bulge
        s1, s2, s3 = F.lit(orbit) - far * F.cos(a) * F.cos(b), far * F.sin(a) * F.cos(b), far * F.sin(b)
        lat, lon = F.atan(F.lit(q) * s3 / F.sqrt(s1 * s1 + s2 * s2)), F.atan(s2 / s1)
        return F.when(inside >= 0, F.degrees(lat)), F.when(inside >= 0, F.degrees(lon) + F.lit(lon_0))

    return Projection(inverse, dx, dy)


def pixel_weights(pixels: DataFrame, projection: Projection, resolution: float, sub: int = 4, x: str = "x", y: str = "y") -> DataFrame:
    """``x, y, lat, lon, w``: how many of a pixel's points fall into each target cell (named by its centre)."""
    every = lambda d: F.explode(F.array(*[F.lit(((k + 0.5) / sub - 0.5) * d) for k in range(sub)]))
    points = pixels.select(x, y).distinct().select(x, y, every(projection.dx).alias("__a")).select(x, y, "__a", every(projection.dy).alias("__b"))
    lat, lon = projection.inverse(F.col(x) + F.col("__a"), F.col(y) + F.col("__b"))
    cell = points.select(x, y, F.floor(lat / F.lit(resolution)).alias("__i"), F.floor(lon / F.lit(resolution)).alias("__j")).where("__i IS NOT NULL AND __j IS NOT NULL")
    centre = lambda c: ((F.col(c) + 0.5) * F.lit(resolution))
    return cell.groupBy(x, y, "__i", "__j").agg(F.count(F.lit(1)).alias("w")).select(x, y, centre("__i").alias("lat"), centre("__j").alias("lon"), "w")


def reproject(cube: DataFrame, projection: Projection, resolution: float, cols: Sequence[str], sub: int = 4, x: str = "x", y: str = "y", time: str = "time",
              sum_decimals: int | None = None) -> DataFrame:
    """``lat, lon, time`` and the area-weighted mean of each variable in every cell that a pixel reaches
    (NULL where none of them has a value). ``sum_decimals`` rounds sums of fixed-decimal data."""
    w = pixel_weights(cube, projection, resolution, sub, x, y).withColumnsRenamed({x: "__x", y: "__y", "lat": "__lat", "lon": "__lon", "w": "__w"})
    j = cube.select(x, y, time, *cols).join(w, (F.col(x) == F.col("__x")) & (F.col(y) == F.col("__y")))
    exact = lambda c: c if sum_decimals is None else F.round(c, sum_decimals)
    means = [F.try_divide(exact(F.sum(F.col(c) * F.col("__w"))), F.sum(F.when(F.col(c).isNotNull(), F.col("__w")))).alias(c) for c in cols]
    return j.groupBy(F.col("__lat").alias("lat"), F.col("__lon").alias("lon"), time).agg(*means)
