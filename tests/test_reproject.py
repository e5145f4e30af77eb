"""Reprojection (C5): inverse formulas against the forward ones, area weights against a fine grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracube.operators import reproject as RP


def test_sinusoidal_inverse_undoes_the_map(spark):
    lat, lon = np.meshgrid(np.linspace(-85, 85, 13), np.linspace(-170, 170, 13))
    x, y = RP.SPHERE * np.radians(lon) * np.cos(np.radians(lat)), RP.SPHERE * np.radians(lat)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(d)) for a, b, c, d in zip(x.ravel(), y.ravel(), lat.ravel(), lon.ravel())], "x double, y double, la double, lo double")
    got = RP.sinusoidal(1.0, 1.0, lon_0=20.0).inverse(F.col("x"), F.col("y"))
    for r in df.select("la", "lo", got[0].alias("lat"), got[1].alias("lon")).collect():
        assert r.lat == pytest.approx(r.la, abs=1e-9) and r.lon == pytest.approx(r.lo + 20, abs=1e-9)


def test_geostationary_inverse_undoes_the_view(spark):
    h, q, rows = RP.ORBIT - RP.EQUATOR, (RP.EQUATOR / RP.POLE) ** 2, []
    for la in (-60.0, -20.0, 0.0, 35.0, 70.0):
        for lo in (-55.0, 0.0, 12.5, 60.0):
            c = np.arctan(np.tan(np.radians(la)) / q)  # geocentric latitude
            r = RP.POLE / np.sqrt(1 - (1 - 1 / q) * np.cos(c) ** 2)
            v = np.array([RP.ORBIT - r * np.cos(c) * np.cos(np.radians(lo)), r * np.cos(c) * np.sin(np.radians(lo)), r * np.sin(c)])
            rows.append((float(np.arctan(v[1] / v[0]) * h), float(np.arcsin(v[2] / np.linalg.norm(v)) * h), la, lo))
    rows.append((float(0.16 * h), 0.0, None, None))  # off the disc
    got = RP.geostationary(1.0, 1.0).inverse(F.col("x"), F.col("y"))
    for r in spark.createDataFrame(rows, "x double, y double, la double, lo double").select("la", "lo", got[0].alias("lat"), got[1].alias("lon")).collect():
        assert (r.lat, r.lon) == ((None, None) if r.la is None else (pytest.approx(r.la, abs=1e-6), pytest.approx(r.lo, abs=1e-6)))


def test_means_are_weighted_by_area(spark):
    step = RP.SPHERE * np.pi / 180  # a pixel of one degree at the equator, cells of two thirds of it
    rows = [(i * step + step / 2, j * step + step / 2, t, None if (i, j, t) == (1, 0, 2) else float(i + 10 * j + 100 * t)) for i in range(3) for j in range(2) for t in (1, 2)]
    df = spark.createDataFrame(rows + [(1e9, 0.0, 1, 5.0), (0.0, 2e7, 1, 5.0)], "x double, y double, time int, v double")
    got = {(round(r.lat, 6), round(r.lon, 6), r.time): r.v for r in RP.reproject(df, RP.sinusoidal(step, step), 2 / 3, ["v"], sub=30).collect()}
    fine, n = {}, 30
    for x, y, t, v in rows:
        for a in range(n):
            for b in range(n):
                la = (y + ((b + 0.5) / n - 0.5) * step) / RP.SPHERE
                lo = np.degrees((x + ((a + 0.5) / n - 0.5) * step) / (RP.SPHERE * np.cos(la)))
                fine.setdefault((round((np.floor(np.degrees(la) * 1.5) + 0.5) / 1.5, 6), round((np.floor(lo * 1.5) + 0.5) / 1.5, 6), t), []).append(v)
    assert set(got) == set(fine) and len(got) > 20  # the two pixels off the map are in no cell
    for k, vs in fine.items():
        vs = [v for v in vs if v is not None]
        assert got[k] == (pytest.approx(np.mean(vs)) if vs else None)
