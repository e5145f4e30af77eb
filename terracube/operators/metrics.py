"""Forecast verification.

All metrics are single-pass partial aggregates (sums of moments), so they
cost one scan and a tiny final merge regardless of data size (F4: abs,
sqrt, pow, round are the built-in Column functions).  Arguments are always
(truth, prediction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracube.functions.quantile import quantile_row


def metric_columns(y: str = "y", p: str = "prediction",
                   sum_decimals: int | None = None) -> list[Column]:
    e = F.col(y) - F.col(p)
    n = F.count(F.lit(1))

    def mean(c: Column) -> Column:
        if sum_decimals is None:
            return F.avg(c)
        return F.try_divide(F.round(F.sum(c), sum_decimals), n)

    return [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),                                   # A15
        mean(F.abs(e)).alias("mae"),                                          # A16
        (F.lit(1.0) - F.try_divide(F.var_pop(e), F.var_pop(y))).alias("explained_variance"),  # A17
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),  # A18
        (F.try_divide(mean(F.col(p)) - mean(F.col(y)), mean(F.col(y))) * 100).alias("pct_bias"),  # A19
    ]


def verify(df: DataFrame, y: str = "y", p: str = "prediction", by: Sequence[str] = (),
           sum_decimals: int | None = None) -> DataFrame:
    """A15-A19 over the rows that have both a truth and a prediction."""
    df = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(*metric_columns(y, p, sum_decimals))


def smooth_l1(y: str = "y", p: str = "prediction", sum_decimals: int | None = None) -> Column:
    """Mean smooth-L1 loss (beta 1)."""
    e = F.abs(F.col(y) - F.col(p))
    loss = F.when(e < 1, 0.5 * e * e).otherwise(e - 0.5)
    if sum_decimals is None:
        return F.avg(loss).alias("smooth_l1")
    return F.try_divide(F.round(F.sum(loss), sum_decimals), F.count(loss)).alias("smooth_l1")


def error_map(df: DataFrame, y: str = "y", p: str = "prediction") -> DataFrame:
    """``difference = truth - prediction`` per cell."""
    return df.withColumn("difference", F.col(y) - F.col(p))


def quantile_bands(df: DataFrame, y: str = "y", values: DataFrame | None = None) -> DataFrame:
    """Label rows by the truth's quantiles: low (< q.2), mid
    (q.4 < y < q.6), high (> q.8), strict; other rows get no band.
    ``values``: the same truth column from a cheaper plan, if there is one."""
    q = quantile_row(df.select(y) if values is None else values, y, [0.2, 0.4, 0.6, 0.8], ["__q20", "__q40", "__q60", "__q80"])
    j = df.crossJoin(F.broadcast(q))
    band = (F.when(F.col(y) < F.col("__q20"), "low")
             .when(F.col(y) > F.col("__q80"), "high")
             .when((F.col(y) > F.col("__q40")) & (F.col(y) < F.col("__q60")), "mid"))
    return j.withColumn("band", band).drop("__q20", "__q40", "__q60", "__q80")


def error_quantile_mask(df: DataFrame, q: float = 0.9, above: bool = True,
                        diff: str = "difference") -> DataFrame:
    """Cells whose ``abs(difference)`` is above (or below) its q-quantile."""
    a = df.withColumn("__abs", F.abs(F.col(diff)))
    thr = quantile_row(a, "__abs", [q], ["thr"]).scalar()
    cond = F.col("__abs") > thr if above else F.col("__abs") < thr
    return a.where(cond).drop("__abs")
