"""Regridding as weight tables and equi joins.

An axis is the sorted distinct coordinate values of one dimension.  Its
size is set by the grid resolution (a global 0.01 degree grid has 36,000
longitudes), not by the data volume.  The cube is only ever equi-joined to the
per-axis weight tables and aggregated on the target keys; AQE measures the
tables and broadcasts them when they are small.  Callers that know a cheaper
source of the axes (the raw product instead of its resampled form) pass them in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.session import dealt

#: Target longitudes of one row before the cells of a block are generated.
BLOCK = 1024


def axis(df: DataFrame, dim: str) -> DataFrame:
    return df.select(F.col(dim).cast("double").alias("v")).distinct()


def _neighbours(src_axis: DataFrame, dst_axis: DataFrame) -> DataFrame:
    """For each target value: the nearest source value below-or-equal (``a``)
    and strictly above (``a1``), found by a sort of the merged axes in each direction."""
    marked = (src_axis.select(F.col("v"), F.lit(0).alias("is_dst"))
              .unionByName(dst_axis.select(F.col("v"), F.lit(1).alias("is_dst"))))
    # both frames run forward, one over each order: a frame that ends with the partition is evaluated anew for every row
    w_prev = Window.orderBy("v", "is_dst").rowsBetween(Window.unboundedPreceding, 0)
    w_next = Window.orderBy(F.col("v").desc(), F.col("is_dst").desc()).rowsBetween(Window.unboundedPreceding, -1)
    src_v = F.when(F.col("is_dst") == 0, F.col("v"))
    n = marked.select("v", "is_dst",
                      F.last(src_v, ignorenulls=True).over(w_prev).alias("a"),
                      F.last(src_v, ignorenulls=True).over(w_next).alias("a1"))
    # a1 must be strictly above v: a source equal to v sorts before the target
    return n.where(F.col("is_dst") == 1).select(F.col("v").alias("dst"), "a", "a1")


def nearest_map(src_axis: DataFrame, dst_axis: DataFrame) -> DataFrame:
    """J5 per axis: ``(dst, src)``, tie -> lower coordinate."""
    n = _neighbours(src_axis, dst_axis)
    pick = (F.when(F.col("a").isNull(), F.col("a1"))
             .when(F.col("a1").isNull(), F.col("a"))
             .when((F.col("dst") - F.col("a")) <= (F.col("a1") - F.col("dst")), F.col("a"))
             .otherwise(F.col("a1")))
    return n.select("dst", pick.alias("src"))


def bilinear_weights(src_axis: DataFrame, dst_axis: DataFrame) -> DataFrame:
    """J6 per axis: ``(dst, src, w, nw)`` with at most two sources per target.

    ``w0 = (a1 - b) / (a1 - a)`` on ``[a, a1)``; a target on the last node
    takes that node with weight 1; targets outside the hull get no row.
    Zero weights are dropped, ``nw`` is the number of sources kept.
    """
    n = _neighbours(src_axis, dst_axis).where(F.col("a").isNotNull())
    on_node = F.col("dst") == F.col("a")
    inside = n.where(on_node | F.col("a1").isNotNull())
    w0 = F.when(on_node, F.lit(1.0)).otherwise((F.col("a1") - F.col("dst")) / (F.col("a1") - F.col("a")))
    pairs = inside.select("dst", F.array(
        F.struct(F.col("a").alias("src"), w0.alias("w")),
        F.struct(F.col("a1").alias("src"), (F.lit(1.0) - w0).alias("w"))).alias("p"))
    e = pairs.select("dst", F.explode("p").alias("p")).select("dst", "p.src", "p.w")
    e = e.where((F.col("w") != 0) & F.col("src").isNotNull())
    return e.withColumn("nw", F.count(F.lit(1)).over(Window.partitionBy("dst")))


def regrid_nearest(cube: DataFrame, dst_lat: DataFrame, dst_lon: DataFrame, cols: Sequence[str], time: str = "time",
                   src_lat: DataFrame | None = None, src_lon: DataFrame | None = None) -> DataFrame:
    """Every target cell takes the values of its nearest source cell."""
    lat_m = nearest_map(src_lat or axis(cube, "lat"), dst_lat).withColumnsRenamed({"dst": "__dlat", "src": "__slat"})
    lon_m = nearest_map(src_lon or axis(cube, "lon"), dst_lon).withColumnsRenamed({"dst": "__dlon", "src": "__slon"})
    j = (cube.join(lat_m, cube["lat"] == lat_m["__slat"])
             .join(lon_m, F.col("lon") == F.col("__slon")))
    return j.select(F.col("__dlat").alias("lat"), F.col("__dlon").alias("lon"), time, *cols)


def _cells(steps: DataFrame, dst_lat: DataFrame, dst_lon: DataFrame, time: str) -> DataFrame:
    """``lat, lon, time`` of every target cell and step. The narrow rows before the last
    generator are dealt by number, as few bytes would else be read by one task."""
    lats, lons = (dst.agg(F.array_sort(F.collect_set("v"))).scalar() for dst in (dst_lat, dst_lon))  # sorted: slices need one order
    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(lons) - 1, F.lit(0)) / BLOCK).cast("int"))
    rows = steps.select(time, F.explode(lats).alias("lat")).select(time, "lat", F.explode(blocks).alias("__block"))
    return dealt(rows, time, "lat", "__block").select("lat", F.explode(F.slice(lons, F.col("__block") * BLOCK + 1, BLOCK)).alias("lon"), time)


def regrid_bilinear(cube: DataFrame, dst_lat: DataFrame, dst_lon: DataFrame, cols: Sequence[str], time: str = "time",
                    src_lat: DataFrame | None = None, src_lon: DataFrame | None = None, times: DataFrame | None = None) -> DataFrame:
    """``sum(w_lat * w_lon * v)`` for every target cell and time step.

    A value is NULL unless every one of its ``nw_lat * nw_lon`` corners exists and
    is non-missing; cells outside the source's hull are there with NULL. The
    target grid's cells come from a generator over its two axes, which one row
    holds as arrays; blocks of ``BLOCK`` longitudes are dealt over the shuffle
    partitions. They meet the weighted source rows in the one aggregate on
    (target lat, target lon, time).
    """
    lw = (bilinear_weights(src_lat or axis(cube, "lat"), dst_lat)
          .withColumnsRenamed({"dst": "__dlat", "src": "__slat", "w": "__wlat", "nw": "__nlat"}))
    ow = (bilinear_weights(src_lon or axis(cube, "lon"), dst_lon)
          .withColumnsRenamed({"dst": "__dlon", "src": "__slon", "w": "__wlon", "nw": "__nlon"}))
    j = (cube.join(lw, cube["lat"] == lw["__slat"])
             .join(ow, F.col("lon") == F.col("__slon")))
    j = j.select(F.col("__dlat").alias("lat"), F.col("__dlon").alias("lon"), time, (F.col("__wlat") * F.col("__wlon")).alias("__w"),
                 (F.col("__nlat") * F.col("__nlon")).alias("__need"), *cols)
    steps = (times if times is not None else cube.select(time)).distinct()
    types = dict(cube.dtypes)
    cells = _cells(steps, dst_lat, dst_lon, time).select("lat", "lon", time, F.lit(None).cast("double").alias("__w"), F.lit(None).cast("long").alias("__need"),
                         *[F.lit(None).cast(types[c]).alias(c) for c in cols])
    aggs = [F.count("__w").alias("__rows"), F.max("__need").alias("__need")]
    for c in cols:
        aggs += [F.sum(F.col("__w") * F.col(c)).alias(c), F.count(c).alias(f"__n_{c}")]
    # at most four corners and the cell itself: nothing for a partial aggregate to combine
    g = dealt(j.unionByName(cells), "lat", "lon", time).groupBy("lat", "lon", time).agg(*aggs)
    full = F.col("__rows") == F.col("__need")
    return g.select("lat", "lon", time,
                    *[F.when(full & (F.col(f"__n_{c}") == F.col("__need")), F.col(c)).alias(c) for c in cols])
