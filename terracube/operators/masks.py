"""Land/sea, reference, validity and drought masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracube.operators.slicing import time_index
from terracube.schema import PIXEL, pixel_keys


def land_mask(df: DataFrame, var: str = "spi", t_index: int = 1, time: str = "time") -> DataFrame:
    """land = ``var`` present at calendar position ``t_index``.

    Output ``(lat, lon, land)`` for every pixel of the cube; a pixel with no
    row at that time is sea, as in a dense cube where the cell is missing.
    """
    # one partial aggregate over the cube: every pixel appears, and its flag
    # is true iff some row at that calendar position has the variable
    ti = time_index(df.select(*PIXEL, time, var), time, "__ti")
    present = (F.col("__ti") == t_index) & F.col(var).isNotNull()
    return ti.groupBy(*PIXEL).agg(F.coalesce(F.bool_or(present), F.lit(False)).alias("land"))


def apply_mask(df: DataFrame, mask: DataFrame, cols: Sequence[str], flag: str = "land",
               keep_when: bool = True) -> DataFrame:
    """Static per-pixel mask repeated over time; values off the
    mask become NULL, rows are kept.

    The mask has one row per pixel: it is not hinted, AQE broadcasts it at
    run time when its measured size is under the threshold and falls back
    to a shuffle join otherwise.
    """
    m = mask.select(*PIXEL, F.col(flag).alias("__flag"))
    j = df.join(m, PIXEL, "left")
    ok = F.coalesce(F.col("__flag") == F.lit(keep_when), F.lit(False))
    return j.withColumns({c: F.when(ok, F.col(c)) for c in cols}).drop("__flag")


def sea_pixels(mask: DataFrame, flag: str = "land") -> DataFrame:
    """Pixels to remove."""
    return mask.where(~F.col(flag)).select(*PIXEL)


def reference_mask(df: DataFrame, var: str, time: str = "time", t_index: int = 0) -> DataFrame:
    """``masked`` = ``var`` missing at the first time step (static)."""
    lm = land_mask(df, var, t_index, time)
    return lm.select(*PIXEL, (~F.col("land")).alias("masked"))


def all_valid(df: DataFrame, cols: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Keep ``value`` only where every product in ``cols`` is present."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.withColumn(out or value, F.when(cond, F.col(value)))


def to_boolean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric 0/1 masks to boolean; missing stays NULL."""
    return df.withColumns({c: F.col(c).cast("boolean") for c in cols})


def threshold_flag(col: str, limit: float = -1.0) -> Column:
    """Strict ``col < limit``, missing -> False."""
    return F.coalesce(F.col(col) < F.lit(limit), F.lit(False))


def invert(col: str) -> Column:
    """P24."""
    return ~F.col(col)


def _rounded(c: Column, decimals: int | None) -> Column:
    return c if decimals is None else F.round(c, decimals)


def series_drought(df: DataFrame, var: str = "ndvi", out: str = "drought_ndvi", decimals: int | None = None) -> DataFrame:
    """``v < mean_t - std_t`` per pixel over the whole series (population std).

    One exchange on the pixel; the frame is the whole partition, computed by
    the window operator's spillable buffer.  ``decimals`` rounds the threshold
    for callers that compare engines; by default it is used as it is.
    """
    w = Window.partitionBy(*pixel_keys(df))
    thr = _rounded(F.avg(var).over(w) - F.stddev_pop(var).over(w), decimals)
    return df.withColumn(out, F.coalesce(F.col(var) < thr, F.lit(False)))


def monthly_drought(df: DataFrame, var: str = "ndvi", out: str = "drought_ndvi",
                    time: str = "time", decimals: int | None = None) -> DataFrame:
    """Same rule within each (pixel, calendar month)."""
    w = Window.partitionBy(*pixel_keys(df), F.month(time))
    thr = _rounded(F.avg(var).over(w) - F.stddev_pop(var).over(w), decimals)
    return df.withColumn(out, F.coalesce(F.col(var) < thr, F.lit(False)))


def pixel_month_zscore(df: DataFrame, expr: Column, out: str, time: str = "time", decimals: int | None = None) -> DataFrame:
    """Standardised index per (pixel, month) with population std; used to
    build SPI/SPEI stand-ins when the ready-made products are absent."""
    w = Window.partitionBy(*pixel_keys(df), F.month(time))
    z = F.try_divide(expr - F.avg(expr).over(w), F.stddev_pop(expr).over(w))
    return df.withColumn(out, _rounded(z, decimals))
