"""Reference-shaped cube derived from the driver tables.

No climate archive is available, so a monthly grid is derived from
``lineitem``: latitude from the supplier, longitude from supplier and line
number, time = month of shipment.  Every variable is an integer floor
division scaled to a fixed number of decimals, so the values are exact and
identical in any engine.  Deterministic sentinels (200) and NULLs are
injected by modulus of the order-key sum so the masks have work to do.

The job is one partial+final hash aggregate on (iy, ix, month); the partial
aggregate runs map-side, so the shuffle carries one row per
(task, cell, month), not per line item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracube.functions.time import trunc_ntz
from terracube.sources.tables import read_table



def monthly_grid(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select("l_suppkey", "l_linenumber", "l_shipdate", "l_quantity",
                         "l_extendedprice", "l_discount", "l_tax", "l_orderkey")
    c = (li.groupBy(
            (F.col("l_suppkey") % 5).alias("iy"),
            (F.expr("(l_suppkey div 5) * 2 + l_linenumber % 2")).alias("ix"),
            trunc_ntz("month", "l_shipdate").alias("time"))
         .agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.round("l_quantity").cast("bigint")).alias("q"),
              F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("p"),
              F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("d"),
              F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("t"),
              F.sum("l_orderkey").cast("bigint").alias("ok")))
    return c.selectExpr(
        "CAST(iy AS DOUBLE) * 25e-2 AS lat",
        "CAST(ix AS DOUBLE) * 25e-2 AS lon",
        "time",
        "CASE WHEN ok % 53 = 0 THEN 2e2 ELSE ((q * 100) div n) / 1e2 END AS lst_day",
        "CASE WHEN ok % 59 = 0 THEN 2e2 ELSE ((q * 60) div n) / 1e2 END AS lst_night",
        "(p div (n * 1000)) / 1e2 AS precip",
        "CASE WHEN ok % 61 = 0 THEN NULL ELSE ((t * 50) div n) / 1e3 END AS sm",
        "((d * 100) div n) / 1e3 AS ndvi",
        "((d * 60 + t * 10) div n) / 1e3 AS evi",
    )


def load_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_grid(read_table(spark, sf_dir, "lineitem"))


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations for resampling: pixel = user_id, time = day."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("user_id", trunc_ntz("day", "ts").alias("time"), "value")


def daily_product(orders: DataFrame, n_lon: Column) -> DataFrame:
    """A second, differently shaped product for harmonisation.

    Daily time step, a 0.2-degree grid of 6 latitudes and ``n_lon`` longitudes
    offset from the monthly cube, long coordinate names and generic variable
    names (``latitude``, ``longitude``, ``time``, ``value``, ``orders``): the shape
    the harmonise step has to bring onto the reference grid.  ``value`` is the
    day's order total (rounded to cents, so it is exact) in thousands, ``orders``
    their number.
    """
    o = orders.select("o_custkey", "o_orderdate", "o_totalprice")
    g = (o.groupBy(F.expr("CAST(o_custkey % 6 AS DOUBLE) * 2e-1").alias("latitude"),
                   (F.expr("o_custkey div 6") % n_lon).cast("double").alias("__x"),
                   F.col("o_orderdate").alias("time"))
          .agg(F.round(F.sum("o_totalprice"), 2).alias("__s"), F.count(F.lit(1)).cast("double").alias("orders")))
    return g.select("latitude", (F.col("__x") * F.lit(2e-1)).alias("longitude"), "time", (F.col("__s") / 1e3).alias("value"), "orders")


def load_daily_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product's longitudes span those of the monthly grid, whose number follows the suppliers."""
    n_lon = read_table(spark, sf_dir, "supplier").agg(F.expr("max(s_suppkey) div 2 + 3")).scalar()
    return daily_product(read_table(spark, sf_dir, "orders"), n_lon)
