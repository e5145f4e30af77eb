"""Cleaning operators: sentinel masks, anomalies, null removal, z-scores."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.schema import CUBE_KEYS, LST_COLS, LST_SENTINEL, PIXEL, PIXEL_ID, pixel_keys


def cluster_by_pixel(df: DataFrame) -> DataFrame:
    """Hash-partition a cube by pixel once.

    Every pixel-local operator downstream (anomaly per pixel-month, drought
    thresholds, lags, 12-month examples per pixel-year) needs its rows
    clustered by keys that *start with* (lat, lon), which this partitioning
    satisfies: one exchange instead of one per window.  A pixel's whole
    series is bounded by the calendar length, so no partition grows with the
    number of pixels; AQE coalesces small partitions.
    """
    return df.withColumn(PIXEL_ID, F.xxhash64(*PIXEL)).repartition(PIXEL_ID)


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Ingest rule (F5): NaN becomes NULL once, NULL is the only missing marker after.
    Default: every variable; the coordinates stay as they are, so that their filters
    reach the scan."""
    cols = [c for c, t in df.dtypes if t in ("double", "float") and c not in CUBE_KEYS] if cols is None else list(cols)
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def mask_sentinel(df: DataFrame, cols: Iterable[str] | None = None,
                  sentinel: float = LST_SENTINEL) -> DataFrame:
    """P5: values >= sentinel become NULL (strict ``< sentinel`` keeps, F13 ``when``).
    Default columns: every variable whose name contains ``lst`` (F8)."""
    if cols is None:
        cols = [c for c in df.columns if "lst" in c]
    return df.withColumns({c: F.when(F.col(c) < sentinel, F.col(c)) for c in cols})


def mask_by_other(df: DataFrame, control: str = "lst_mean", limit: float = 100.0,
                  cols: Iterable[str] | None = None) -> DataFrame:
    """Keep each ``lst`` variable only where ``control < limit``."""
    if cols is None:
        cols = [c for c in df.columns if "lst" in c]
    cond = F.col(control) < limit
    return df.withColumns({c: F.when(cond, F.col(c)) for c in cols})


def anomaly(df: DataFrame, var: str = "ndvi", out: str | None = None,
            clim_before_year: int = 2016, group: str = "month",
            time: str = "time") -> DataFrame:
    """Value minus its pixel climatology (mean over years < cut).

    A conditional average over ``partitionBy(lat, lon, month)``: one hash
    shuffle on the pixel-month, no join back.  Rows outside the
    climatology years still get an anomaly, and rows dropped later still
    count in the mean (the climatology is taken before any null removal).
    """
    out = out or f"{var}_anomaly"
    part = F.month(time) if group == "month" else F.dayofyear(time)
    w = Window.partitionBy(*pixel_keys(df), part)
    clim = F.avg(F.when(F.year(time) < clim_before_year, F.col(var))).over(w)
    return df.withColumn(out, F.col(var) - clim)


def climatology(df: DataFrame, var: str = "ndvi", clim_before_year: int | None = 2016,
                time: str = "time") -> DataFrame:
    """A2: per (lat, lon, month) mean of ``var`` over years before the cut."""
    v = F.col(var) if clim_before_year is None else F.when(F.year(time) < clim_before_year, F.col(var))
    return (df.groupBy(*PIXEL, F.month(time).alias("month"))
              .agg(F.avg(v).alias(f"{var}_clim")))


def subtract_climatology(df: DataFrame, clim: DataFrame, var: str = "ndvi",
                         out: str | None = None, time: str = "time") -> DataFrame:
    """The join form of W1 (equi join on lat, lon, month)."""
    out = out or f"{var}_anomaly"
    j = df.withColumn("month", F.month(time)).join(clim, [*PIXEL, "month"], "left")
    return j.withColumn(out, F.col(var) - F.col(f"{var}_clim")).drop("month", f"{var}_clim")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop any row with a NULL in *any* column (before projection)."""
    return df.na.drop(how="any")


def copy_target(df: DataFrame, target: str, allowed: Iterable[str]) -> DataFrame:
    """Raw-unit copy of the prediction target."""
    allowed = list(allowed)
    if target not in allowed:
        raise ValueError(f"{target} not in {allowed}")
    return df.withColumn("target", F.col(target))


def normalising_stats(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """A1 statistics: one global aggregate, mean and *sample* std per column.

    Partial aggregation runs map-side; the final merge sees one buffer per
    task, so the single output row is cheap at any scale.  Long form
    ``(variable, mean, std)`` via ``stack``.
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, mean, std)")


def zscore(df: DataFrame, cols: Iterable[str], stats: DataFrame | None = None) -> DataFrame:
    """A1: ``(x - mean) / std`` with global statistics of every row.

    The statistics are a single-row frame cross-joined by broadcast (size is
    one row regardless of data size).  ``try_divide`` keeps std = 0 or NULL
    from raising under ANSI mode.
    """
    cols = list(cols)
    if stats is None:
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"__m_{c}"), F.stddev_samp(c).alias(f"__s_{c}")]
        wide = df.agg(*aggs)
    else:
        aggs = []
        for c in cols:
            aggs += [F.max(F.when(F.col("variable") == c, F.col("mean"))).alias(f"__m_{c}"),
                     F.max(F.when(F.col("variable") == c, F.col("std"))).alias(f"__s_{c}")]
        wide = stats.agg(*aggs)
    j = df.crossJoin(F.broadcast(wide))
    j = j.withColumns({c: F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")) for c in cols})
    return j.drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def denormalise(df: DataFrame, stats: DataFrame, value: str = "value",
                variable: str = "variable", out: str = "value_raw") -> DataFrame:
    """``x * std + mean`` via a broadcast join on the (tiny) stats table."""
    s = F.broadcast(stats.select(F.col("variable").alias("__v"), "mean", "std"))
    j = df.join(s, F.col(variable) == F.col("__v"), "left")
    return j.withColumn(out, F.col(value) * F.col("std") + F.col("mean")).drop("__v", "mean", "std")


def mask_lst(df: DataFrame) -> DataFrame:
    """P5 as the cleaner applies it: the two LST columns only."""
    return mask_sentinel(df, LST_COLS)
