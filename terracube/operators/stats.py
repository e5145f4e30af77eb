"""Descriptive statistics over cubes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.functions.quantile import exact_quantiles, quantile_row
from terracube.schema import PIXEL


def long_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Unpivot variables to ``(keys..., variable, value)``; NULLs dropped."""
    cols = list(cols)
    long = df.unpivot(list(keys), cols, "variable", "value") if keys else \
        df.select(*cols).unpivot([], cols, "variable", "value")
    return long.where(F.col("value").isNotNull())


def non_null_values(df: DataFrame, var: str) -> DataFrame:
    """Flattened non-missing values of one variable."""
    return df.select(var).where(F.col(var).isNotNull())


def mean_col(c: str, sum_decimals: int | None = None) -> F.Column:
    """``avg`` (= sum / count).  With ``sum_decimals`` the sum is rounded
    first: for fixed-decimal data that removes the summation-order noise, so
    the mean is the correctly rounded quotient in any engine or partitioning."""
    if sum_decimals is None:
        return F.avg(c)
    return F.try_divide(F.round(F.sum(c), sum_decimals), F.count(c))


def time_mean(df: DataFrame, cols: Sequence[str], sum_decimals: int | None = None) -> DataFrame:
    """Per-pixel mean over time."""
    return df.groupBy(*PIXEL).agg(*[mean_col(c, sum_decimals).alias(c) for c in cols])


def seasonal_max(df: DataFrame, var: str, time: str = "time") -> DataFrame:
    """Monthly mean per pixel, then the maximum over pixels per month.

    Two aggregates; the first shuffles partial sums per (pixel, month), the
    second only 12 groups whose partial maxima are combined map-side.
    """
    m = df.groupBy(*PIXEL, F.month(time).alias("month")).agg(F.avg(var).alias("m"))
    return m.groupBy("month").agg(F.max("m").alias(f"{var}_max_monthly_mean"))


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def distinct_counts(df: DataFrame, time: str = "time") -> DataFrame:
    """Distinct lats, lons, pixels, times and years.

    ``count_distinct`` of a few small axes: Spark plans one expand + two
    aggregates, all partial, no group collected.
    """
    return df.agg(F.count_distinct("lat").alias("n_lat"),
                  F.count_distinct("lon").alias("n_lon"),
                  F.count_distinct("lat", "lon").alias("n_pixels"),
                  F.count_distinct(time).alias("n_times"),
                  F.count_distinct(F.year(time)).alias("n_years"))


def describe(df: DataFrame, cols: Sequence[str], sum_decimals: int | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per variable."""
    long = long_values(df, cols)
    base = long.groupBy("variable").agg(
        F.count(F.lit(1)).alias("count"), mean_col("value", sum_decimals).alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = quantile_row(long, "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], ["variable"], few_groups=True)  # a group per column
    return base.join(q, "variable")


def histogram(df: DataFrame, var: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max], last edge closed (numpy rule).

    Bounds come from a one-row aggregate broadcast back; counts are a
    partial aggregate over at most ``bins`` groups. Empty bins have count 0; a
    single value makes one bin.
    """
    v = non_null_values(df, var)
    b = v.agg(F.min(var).alias("lo"), F.max(var).alias("hi"))
    j = v.crossJoin(F.broadcast(b))
    raw = F.floor(F.try_divide(F.col(var) - F.col("lo"), F.col("hi") - F.col("lo")) * bins) + 1
    bucket = F.when(raw < bins, raw).when(F.col("hi") > F.col("lo"), bins).otherwise(1).cast("int")
    counts = j.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    last = F.when(F.col("hi") > F.col("lo"), bins).when(F.col("hi") == F.col("lo"), 1)
    every = b.select("lo", "hi", F.explode(F.sequence(F.lit(1), last)).alias("bucket"))
    return every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("count", F.lit(0)).alias("count"),
        (F.col("lo") + (F.col("bucket") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("edge_lo"))


def percentile_normalise(df: DataFrame, var: str, pct: float = 95.0, out: str | None = None) -> DataFrame:
    """``(x - mean) / (p[50+pct/2] - p[50-pct/2])`` with exact percentiles."""
    out = out or f"{var}_pn"
    lo, hi = (100 - pct) / 200, (100 + pct) / 200
    q = quantile_row(df, var, [lo, hi], ["__plo", "__phi"])
    m = df.agg(F.avg(var).alias("__mean"))
    stats = q.crossJoin(m)
    j = df.crossJoin(F.broadcast(stats))
    return j.withColumn(out, F.try_divide(F.col(var) - F.col("__mean"),
                                          F.col("__phi") - F.col("__plo"))).drop("__plo", "__phi", "__mean")


def quantiles(df: DataFrame, var: str, qs: Sequence[float] = (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)) -> DataFrame:
    """Exact quantiles with linear interpolation, long form (q, quantile)."""
    return exact_quantiles(df, var, qs)


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows under an explicit order (a limit is the
    feature here; Spark plans a TakeOrderedAndProject, i.e. per-task top-n
    then a merge of n rows per task)."""
    return df.orderBy(*order).limit(n)


def stack_labelled(frames: dict, label: str = "data") -> DataFrame:
    """Concatenate frames with the same columns, tagging each with its label."""
    out = None
    for name, f in frames.items():
        t = f.withColumn(label, F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out
