"""Exact quantiles (linear interpolation) by radix selection.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, and a running sum over sorted values needs them in one task.
Here a rank is found digit by digit, whatever the values are distributed like:

1. every double has an order-preserving 64-bit image (its IEEE bits, those of
   negative values inverted), computed by exact column arithmetic;
2. a round counts rows per 16-bit digit of the image, among the rows whose higher
   digits are those of a wanted rank. The counts are partial aggregates of at most
   65,536 rows per group and prefix, and a running sum over them finds the digit
   that holds the rank. After four rounds the image, and so the value, is known.

No round orders values or keeps rows, so neither a long tail nor a value that holds
a third of all rows makes a large task. For ``h = q * (n - 1)`` the ranks are
``floor(h)`` and ``ceil(h)``, and the result is ``v_lo + (h - floor h) * (v_hi - v_lo)``
(the numpy ``linear`` rule, DuckDB ``quantile_cont``, Spark ``percentile``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16
_LEAST_NORMAL = 2.0**-1022


def ordered_bits(x: Column) -> Column:
    """A long that orders as the double ``x`` does (-0.0 as 0.0, NaN last): equal doubles, equal longs."""
    a = F.abs(x)
    near = F.floor(F.log2(a))  # the exponent, or one beside it
    at = F.pow(F.lit(2.0), near)
    exponent = near + F.when(a >= at * 2, 1).when(a < at, -1).otherwise(0)
    normal = (exponent + 1023) * (1 << 52) + ((a / F.pow(F.lit(2.0), exponent) - 1) * 2.0**52).cast("long")
    bits = (F.when(F.isnan(x), F.lit(0x7FF8 << 48)).when(a == float("inf"), F.lit(0x7FF0 << 48)).when(a == 0, F.lit(0))
            .when(a < _LEAST_NORMAL, (a * 2.0**537 * 2.0**537).cast("long")).otherwise(normal))
    return F.when((x >= 0) | F.isnan(x), bits).otherwise(-bits - 1).cast("long")


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], keys: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Long result ``(keys..., q, quantile)``; NULL values are ignored.

    ``few_groups``: the number of groups is fixed by the plan (say, a group per
    column), so the per-group tables are broadcast; without keys they are one row.
    """
    keys, qs = list(keys), sorted(float(q) for q in qs)
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("__v"), ordered_bits(v).alias("__i")).where(F.col("__v").isNotNull())

    def joined(frame: DataFrame, side: DataFrame, *more: str) -> DataFrame:
        return frame.join(F.broadcast(side) if few_groups or not keys else side, [*keys, *more])

    found = None  # a row per prefix that holds wanted ranks: those ranks (their number, and place among the prefix's rows)
    for bits in range(64 - DIGIT, -1, -DIGIT):
        part = rows.withColumn("__d", F.shiftright("__i", bits))
        above = [] if found is None else ["__p"]
        if above:  # the wanted ranks travel with the few rows of the prefixes, so each round is planned once
            part = joined(part.withColumn("__p", F.shiftright("__i", bits + DIGIT)), found.select(*keys, F.col("__d").alias("__p"), "__t", "__n"), "__p")
        more = ["__t", "__n"] if above else []  # fixed by the prefix; as keys, since an array in the buffer makes the aggregate sort all rows
        counts = part.groupBy(*keys, *above, *more, "__d").agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__v"))
        mine = Window.partitionBy(*keys, *above)
        counts = counts.withColumn("__b", F.sum("__c").over(mine.orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c"))
        if not above:
            counts = counts.withColumn("__n", F.sum("__c").over(mine))
            wanted = [F.struct(F.lit(2 * k + up).alias("t"), f(F.lit(q) * (F.col("__n") - 1)).cast("long").alias("r"))
                      for k, q in enumerate(qs) for up, f in enumerate((F.floor, F.ceil))]
            counts = counts.withColumn("__t", F.array(*wanted))
        here = F.filter("__t", lambda t: (t["r"] >= F.col("__b")) & (t["r"] < F.col("__b") + F.col("__c")))
        here = F.transform(here, lambda t: F.struct(t["t"].alias("t"), (t["r"] - F.col("__b")).alias("r")))
        found = counts.withColumn("__t", here).where(F.size("__t") > 0).select(*keys, "__d", "__v", "__n", "__t")
    targets = found.select(*keys, "__v", "__n", F.explode("__t.t").alias("__t"))
    side = lambda up: F.max(F.when(F.col("__t") % 2 == up, F.col("__v")))
    q = F.element_at(F.array(*[F.lit(x) for x in qs]), F.floor(F.col("__t") / 2).cast("int") + 1)
    ends = targets.withColumn("q", q).groupBy(*keys, "q").agg(side(0).alias("__lo"), side(1).alias("__hi"), F.max(F.col("q") * (F.col("__n") - 1)).alias("__h"))
    part = F.col("__h") - F.floor("__h")
    return ends.select(*keys, "q", (F.col("__lo") + F.when(part > 0, part * (F.col("__hi") - F.col("__lo"))).otherwise(0.0)).alias("quantile"))


def quantile_row(df: DataFrame, value: str, qs: Sequence[float], names: Sequence[str], keys: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Wide form: one row per group with one column per quantile name."""
    long = exact_quantiles(df, value, qs, keys, few_groups)
    aggs = [F.max(F.when(F.col("q") == float(q), F.col("quantile"))).alias(n) for q, n in zip(qs, names)]
    return (long.groupBy(*keys) if keys else long.groupBy()).agg(*aggs)
