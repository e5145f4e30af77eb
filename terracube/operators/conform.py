"""Naming and grid-conformity operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Long coordinate names accepted on input.
COORD_ALIASES = {"latitude": "lat", "longitude": "lon", "y": "lat", "x": "lon"}


def normalise_coordinate_names(df: DataFrame) -> DataFrame:
    """latitude/longitude (or y/x) -> lat/lon; a ``time`` column is required."""
    renames = {k: v for k, v in COORD_ALIASES.items() if k in df.columns and v not in df.columns}
    out = df.withColumnsRenamed(renames)
    missing = [c for c in ("lat", "lon", "time") if c not in out.columns]
    if missing:
        raise ValueError(f"missing dimensions: {missing}")
    return out


def rename_variables(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P2."""
    return df.withColumnsRenamed(dict(mapping))


def checked_select(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("lat", "lon", "time")) -> DataFrame:
    """Projection that fails fast when a parameter is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"parameters not found: {missing}")
    return df.select(*keys, *cols)


def axis_summary(df: DataFrame, time: str = "time") -> DataFrame:
    """Distinct lat, lon and time counts plus bounds (one partial aggregate)."""
    return df.agg(F.count_distinct("lat").alias("n_lat"), F.count_distinct("lon").alias("n_lon"),
                  F.count_distinct(time).alias("n_time"),
                  F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
                  F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"))


def check_same_grid(reference: DataFrame, df: DataFrame, time_tolerance: int = 1) -> DataFrame:
    """lat/lon axis lengths equal and time lengths within +-1.

    The two axis summaries are compared when the result is computed, in a filter
    that stays in the plan.
    """
    a, b = (axis_summary(x).select(F.struct("n_lat", "n_lon", "n_time").alias(n)) for x, n in ((reference, "a"), (df, "b")))
    same = ((F.col("a.n_lat") == F.col("b.n_lat")) & (F.col("a.n_lon") == F.col("b.n_lon"))
            & (F.abs(F.col("a.n_time") - F.col("b.n_time")) <= time_tolerance))
    return df.where(F.assert_true(a.join(b).select(same).scalar(), "grids differ in axis lengths").isNull())
