"""Dimension lookups, band <-> time joins and polygon clipping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.functions.geo import DEPTH, FEW, path_parity, point_cells, quadtree_cover
from terracube.functions.lookup import landcover_dimension


def classify_landcover(df: DataFrame, code: str = "code") -> DataFrame:
    """Broadcast left join with the 23-row class dimension."""
    dim = F.broadcast(landcover_dimension(df.sparkSession).withColumnRenamed("code", "__code"))
    return df.join(dim, F.col(code) == F.col("__code"), "left").drop("__code")


def bands_to_time(wide: DataFrame, times: DataFrame, keys: Sequence[str], var: str,
                  prefix: str = "Band") -> DataFrame:
    """``Band1..BandN`` columns <-> the i-th time step.

    ``unpivot`` to (keys, band, value), band index = i, then an equi join
    with ``times(idx, time)``.  The band count must equal the number of times;
    the check is a filter over the result, so column pruning keeps it.
    """
    bands = [c for c in wide.columns if re.fullmatch(re.escape(prefix) + r"\d+", c)]
    long = wide.unpivot(list(keys), bands, "__band", var)
    long = long.withColumn("idx", F.regexp_extract("__band", r"(\d+)$", 1).cast("int")).drop("__band")
    t = times.select(F.col("idx").alias("__idx"), "time")
    same = times.agg(F.count(F.lit(1)) == len(bands)).scalar()
    checked = F.assert_true(same & F.col("__idx").isNotNull(), "band count differs from time count")
    return long.join(t, long["idx"] == t["__idx"], "left").where(checked.isNull()).select(*keys, "time", var)


def time_axis(df: DataFrame, time: str = "time") -> DataFrame:
    """``(idx, time)`` with idx 1..N over the distinct times (calendar-sized)."""
    t = df.select(time).distinct()
    return t.select(F.row_number().over(Window.orderBy(time)).alias("idx"), time)


def clip_to_regions(points: DataFrame, regions: DataFrame, depth: int = DEPTH, few: int = FEW) -> DataFrame:
    """Keep points inside a region, tagged with the region.

    A region ``(country, rings)`` has any number of rings; a point is inside when
    a ray crosses their edges an odd number of times, so inner rings are holes.
    Regions become quadtree leaves (``quadtree_cover``) and points the cells of all
    levels that hold them; both meet in an equi join. A point in a leaf without
    edges is inside; any other is compared with its leaf's few edges. AQE measures
    the cover and broadcasts it when it is small.
    """
    cover = quadtree_cover(regions, depth, few).withColumnsRenamed({"key": "__key", "ax": "__ax", "ay": "__ay", "parity": "__parity", "edges": "__edges"})
    p = points.withColumn("__key", F.explode(point_cells(F.col("lon"), F.col("lat"), depth)))
    off = path_parity(F.col("__edges"), F.col("lon"), F.col("lat"), F.col("__ax"), F.col("__ay"))
    inside = F.when(F.size("__edges") == 0, F.lit(True)).otherwise((F.col("__parity") + off) % 2 == 1)
    return p.join(cover, "__key").where(inside).drop("__key", "__ax", "__ay", "__parity", "__edges")
