"""Time resampling and calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.functions.time import trunc_ntz


def resample_median(df: DataFrame, keys: Sequence[str], var: str | Sequence[str], time: str = "time") -> DataFrame:
    """A3: to month-start labels, median of each variable per period.

    A group is one key's readings of one month, bounded by the calendar; equal
    readings share an entry of the aggregate's buffer.
    """
    names = [var] if isinstance(var, str) else list(var)
    m = df.groupBy(*keys, trunc_ntz("month", time).alias("__period")).agg(*[F.median(v).alias(v) for v in names])
    some = F.coalesce(*[F.col(v) for v in names]).isNotNull()
    return m.where(some).select(*keys, F.col("__period").alias(time), *names)


def resample_first(df: DataFrame, keys: Sequence[str], var: str | Sequence[str], time: str = "time") -> DataFrame:
    """A4: month-end labels, first non-missing value of each variable per period in time order.

    ``min_by`` over non-null rows only: without the filter it would return
    the NULL of the earliest row.  Partial aggregation keeps one candidate
    per (task, group), so a huge group never sits in one buffer.
    """
    names = [var] if isinstance(var, str) else list(var)
    period = F.last_day(time)
    return (df.groupBy(*keys, period.alias("__period"))
              .agg(*[F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(time))).alias(v) for v in names])
              .withColumnRenamed("__period", time))


def infer_freq(df: DataFrame, time: str = "time") -> DataFrame:
    """Classify the time axis as 'D', 'MS', 'M' or NULL (irregular).

    Only global aggregates: the axis is regular iff the number of distinct
    steps equals the calendar span + 1 and every step sits on the grid.
    """
    t = F.col(time)
    a = df.agg(F.count_distinct(t).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"),
               F.bool_and(F.dayofmonth(t) == 1).alias("all_ms"),
               F.bool_and(F.to_date(t) == F.last_day(t)).alias("all_me"),
               F.bool_and(trunc_ntz("day", t) == t.cast("timestamp_ntz")).alias("all_midnight"))
    months = F.months_between(trunc_ntz("month", "hi"), trunc_ntz("month", "lo")).cast("long") + 1
    days = F.datediff(F.to_date("hi"), F.to_date("lo")) + 1
    freq = (F.when(F.col("all_midnight") & F.col("all_ms") & (F.col("n") == months) & (F.col("n") > 1), "MS")
             .when(F.col("all_midnight") & F.col("all_me") & (F.col("n") == months) & (F.col("n") > 1), "M")
             .when(F.col("all_midnight") & (F.col("n") == days) & (F.col("n") > 1), "D"))
    return a.select(freq.alias("freq"), F.col("n").alias("n_steps"))


def densify(df: DataFrame, keys: Sequence[str] = ("lat", "lon"), time: str = "time") -> DataFrame:
    """The full key x calendar product, missing cells as NULL rows.

    The calendar bounds are one broadcast row; each key expands its own
    calendar (month starts from the first to the last month) with ``sequence``, a
    generator.  Observations are attached by a co-group (union, then one aggregate
    on keys and time), so the cube is shuffled once.  An observation that is not on
    the calendar keeps its row; a repeated key raises.
    """
    keys = list(keys)
    values = [c for c in df.columns if c not in keys and c != time]
    types = dict(df.dtypes)
    b = df.agg(F.min(trunc_ntz("month", time)).alias("__lo"), F.max(trunc_ntz("month", time)).alias("__hi"))
    cells = (df.select(*keys).distinct().crossJoin(F.broadcast(b))
               .select(*keys, F.explode(F.sequence(F.col("__lo"), F.col("__hi"), F.expr("INTERVAL 1 MONTH")).cast(f"array<{types[time]}>")).alias(time),
                       *[F.lit(None).cast(types[c]).alias(c) for c in values], F.lit(0).alias("__obs")))
    obs = df.select(*keys, time, *values, F.lit(1).alias("__obs"))
    g = cells.unionByName(obs).groupBy(*keys, time).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values], F.sum("__obs").alias("__obs"))
    return g.where(F.assert_true(F.col("__obs") <= 1, "a key occurs twice in the cube").isNull()).drop("__obs")


def relabel_by_position(reference: DataFrame, df: DataFrame, time: str = "time") -> DataFrame:
    """A22 ``ensure_same_time``: the i-th distinct time of ``df`` becomes the
    reference's first month + i months (month-start labels).

    The time axis is calendar-sized (one row per step), so it is ranked in one
    window; AQE broadcasts the (old, new) map when it measures it as small.
    """
    from pyspark.sql import Window
    start = reference.agg(F.min(trunc_ntz("month", time))).scalar()
    axis = df.select(F.col(time).alias("__old")).distinct()
    axis = axis.select("__old", (F.row_number().over(Window.orderBy("__old")) - 1).alias("__i"))
    m = axis.select("__old", F.add_months(start, F.col("__i").cast("int")).cast("timestamp_ntz").alias("__new"))
    j = df.join(m, F.col(time) == F.col("__old"))
    return j.drop(time, "__old").withColumnRenamed("__new", time).select(*df.columns)
