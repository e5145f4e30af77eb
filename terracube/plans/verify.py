"""C11: verification report for a forecast against the truth.

The forecast here is persistence (previous month's value), produced as its
own keyed frame and aligned with the truth by an equi join (J12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.operators.clean import cluster_by_pixel
from terracube.operators.merge import align_predictions
from terracube.schema import PIXEL, PIXEL_ID, pixel_keys


def persistence_forecast(cube: DataFrame, var: str = "ndvi", time: str = "time") -> DataFrame:
    """Prediction for month t = value at month t-1 (month-index frame)."""
    mi = F.year(time) * 12 + F.month(time)
    w = Window.partitionBy(*pixel_keys(cube)).orderBy(mi).rangeBetween(-1, -1)
    extra = [PIXEL_ID] if PIXEL_ID in cube.columns else []
    return (cube.select(*extra, *PIXEL, time, F.first(var).over(w).alias("prediction"))
                .where(F.col("prediction").isNotNull()))


def truth(cube: DataFrame, var: str = "ndvi", time: str = "time") -> DataFrame:
    extra = [PIXEL_ID] if PIXEL_ID in cube.columns else []
    return cube.select(*extra, *PIXEL, time, F.col(var).alias("y")).where(F.col("y").isNotNull())


def verification_frame(cube: DataFrame, var: str = "ndvi") -> DataFrame:
    """Forecast and truth from one pixel-clustered cube, matched by key
    without a further shuffle."""
    c = cluster_by_pixel(cube.select(*PIXEL, "time", var))
    v = align_predictions(persistence_forecast(c, var), truth(c, var), ["lat", "lon", "time"])
    return v.drop(PIXEL_ID)
