"""Unit conversions and derived variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Conversion factors used by the reference cleaners.
MM_MONTH_TO_MM_DAY = 30.417   # mm/month -> mm/day
WM2_TO_MM_DAY = 28.0          # W/m2 -> mm/day
RESCALE_10 = 10.0             # stored x10


def mean_of(df: DataFrame, out: str, a: str, b: str) -> DataFrame:
    """``out = (a + b) / 2``."""
    return df.withColumn(out, (F.col(a) + F.col(b)) / 2)


def divide_by(df: DataFrame, col: str, factor: float, out: str, unit: str) -> DataFrame:
    """Scaled copy with the unit kept in the column metadata."""
    return df.withColumn(out, (F.col(col) / F.lit(factor)).alias(out, metadata={"units": unit}))


def convert_units(df: DataFrame) -> DataFrame:
    df = divide_by(df, "precip", MM_MONTH_TO_MM_DAY, "precip_mm_day", "mm/day")
    df = divide_by(df, "evi", WM2_TO_MM_DAY, "evi_mm_day", "mm/day")
    return divide_by(df, "sm", RESCALE_10, "sm_rescaled", "m3/m3")
