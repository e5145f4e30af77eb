"""Spatial and temporal selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The East Africa box used by the reference pipeline.
EAST_AFRICA = {"lon_min": 32.6, "lon_max": 51.8, "lat_min": -5.0, "lat_max": 15.2}


def bbox_from_reference(reference: DataFrame, df: DataFrame) -> DataFrame:
    """Keep cells inside the inclusive lat/lon range of ``reference``.

    Each bound is a scalar subquery, so the range predicate reaches the scan.
    """
    bound = lambda f, c: reference.agg(f(c)).scalar()
    return df.where(F.col("lat").between(bound(F.min, "lat"), bound(F.max, "lat"))
                    & F.col("lon").between(bound(F.min, "lon"), bound(F.max, "lon")))


def bbox(df: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> DataFrame:
    """P10: literal box; literal predicates push down to the Parquet scan."""
    return df.where(F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max))


def select_east_africa(df: DataFrame) -> DataFrame:
    return bbox(df, EAST_AFRICA["lat_min"], EAST_AFRICA["lat_max"],
                EAST_AFRICA["lon_min"], EAST_AFRICA["lon_max"])


def time_slice(df: DataFrame, lo: str, hi: str, time: str = "time") -> DataFrame:
    """Inclusive literal time range."""
    return df.where(F.col(time).between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))


def time_slice_from_reference(reference: DataFrame, df: DataFrame, time: str = "time",
                              months: int = 1, days: int = 0) -> DataFrame:
    """``[min, max + 1 period]`` of the reference; the period of its calendar
    is ``months`` and ``days`` (a month by default). The bounds reach the scan."""
    period = F.make_interval(months=F.lit(months), days=F.lit(days))
    return df.where((F.col(time) >= reference.agg(F.min(time)).scalar())
                    & (F.col(time) <= reference.agg(F.max(time) + period).scalar()))


def drop_last_step(df: DataFrame, time: str = "time") -> DataFrame:
    """Remove the final time step (global max), one broadcast scalar."""
    # one scalar referenced once: a scalar subquery keeps the filter in codegen
    return df.where(F.col(time) < df.agg(F.max(time)).scalar())


def time_index(df: DataFrame, time: str = "time", out: str = "t_idx") -> DataFrame:
    """Monthly position of each row on the global calendar (0 = first month).

    Uses month arithmetic against the global minimum, so no window over the
    whole table is needed.
    """
    first = df.agg(F.min(F.year(time) * 12 + F.month(time))).scalar()
    return df.withColumn(out, ((F.year(time) * 12 + F.month(time)) - first).cast("int"))


def isel(df: DataFrame, dim: str, i: int) -> DataFrame:
    """The rows at position ``i`` (negative: from the end) of the axis of ``dim``,
    the sorted distinct values of any dimension; none if the axis is shorter. The
    axis is one array, as long as the grid's dimension."""
    axis = df.agg(F.array_sort(F.collect_set(dim)).alias("a"))
    return df.where(F.col(dim) == axis.select(F.try_element_at("a", F.lit(i + 1 if i >= 0 else i))).scalar())


def time_slice_exact(reference: DataFrame, df: DataFrame, time: str = "time") -> DataFrame:
    """Keep ``[min, max]`` of the reference and require equal step counts.

    [deviation] the lower bound is the reference's own minimum instead of a
    hard-coded date.  The step counts are compared when the result is computed,
    in a filter that stays in the plan.
    """
    out = df.where((F.col(time) >= reference.agg(F.min(time)).scalar()) & (F.col(time) <= reference.agg(F.max(time)).scalar()))
    steps = reference.agg(F.count_distinct(time).alias("a")).join(out.agg(F.count_distinct(time).alias("b")))
    same = steps.select(F.col("a") == F.col("b")).scalar()
    return out.where(F.assert_true(same, "time steps differ after slicing").isNull())
