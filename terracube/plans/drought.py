"""Read-and-mask, then previous-3-month lag sets in and out of drought.

The reference fans out one job per time step and concatenates the results;
here the whole pipeline is one pass over a cube clustered once:

* the cube is hash-partitioned by ``(lon, latitude mirror pair)``, i.e. a
  pixel and its latitude mirror share a partition.  Every pixel-local
  window (monthly z-scores, thresholds, land flag, lags) and the latitude
  flip itself (a lead/lag inside the pair) then run without another
  exchange;
* global scalars (first/last time step) are a broadcast row; the latitude axis
  is a table that AQE measures and broadcasts when it is small;
* both polarities live in one frame with an ``in_drought`` flag.

J13 (cube x mask at t with lagged values) therefore needs no join at all:
the mask and the lags are columns of the same clustered rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.operators.clean import mask_sentinel
from terracube.operators.conform import checked_select
from terracube.operators.masks import pixel_month_zscore, series_drought, threshold_flag
from terracube.operators.windows import lag_stack
from terracube.schema import GRID_VARS, PIXEL_ID

FLAGS = ["drought_spei", "drought_spi", "drought_ndvi"]


def with_drought_indices(grid: DataFrame, decimals: int | None = None) -> DataFrame:
    """SPI/SPEI stand-ins: pixel-month z-scores of precip and precip - lst_day."""
    df = pixel_month_zscore(grid, F.col("precip"), "spi", decimals=decimals)
    return pixel_month_zscore(df, F.col("precip") - F.col("lst_day"), "spei", decimals=decimals)


def lat_pairs(df: DataFrame) -> DataFrame:
    """Latitude axis with rank, reverse rank and mirror-pair id (axis-sized)."""
    ax = df.select("lat").distinct()
    return ax.select("lat",
                     F.row_number().over(Window.orderBy("lat")).alias("__r"),
                     F.row_number().over(Window.orderBy(F.col("lat").desc())).alias("__rr")) \
             .withColumn("__pair", F.least("__r", "__rr"))


def cluster_by_mirror_pair(grid: DataFrame, time: str = "time") -> DataFrame:
    """Attach rank columns, calendar index and the pair hash, partition once."""
    bounds = grid.agg(F.min(time).alias("__t0"), F.max(time).alias("__t1"))
    g = grid.join(lat_pairs(grid), "lat").crossJoin(F.broadcast(bounds))
    g = g.withColumn("t_idx", ((F.year(time) * 12 + F.month(time))
                               - (F.year("__t0") * 12 + F.month("__t0"))).cast("int"))
    return g.withColumn(PIXEL_ID, F.xxhash64("lon", "__pair")).repartition(PIXEL_ID)


def flip_in_pairs(df: DataFrame, col: str, time: str = "time") -> F.Column:
    """W6 inside a mirror pair: the value of the pixel at the mirrored latitude."""
    w = Window.partitionBy(PIXEL_ID, "lon", "__pair", time).orderBy("lat")
    return (F.when(F.col("__r") == F.col("__rr"), F.col(col))
             .when(F.col("__r") < F.col("__rr"), F.lead(col).over(w))
             .otherwise(F.lag(col).over(w)))


def read_and_mask(grid: DataFrame, mask_var: str = "sm",
                  variables: Sequence[str] = GRID_VARS, decimals: int | None = None) -> DataFrame:
    """C6 in one frame: drought flags (P23, A8; sea -> False) next to the
    cleaned variables (final step dropped, precip latitudes flipped, values
    off land -> NULL, LST sentinels -> NULL).  Keeps ``t_idx``."""
    needed = sorted(set(variables) | {"precip", "lst_day", "ndvi", mask_var})
    g = cluster_by_mirror_pair(checked_select(grid, needed))  # P3: fail fast, prune
    pix = Window.partitionBy(PIXEL_ID, "lat", "lon")
    # land = mask variable present at calendar position 1
    land = F.coalesce(F.bool_or((F.col("t_idx") == 1) & F.col(mask_var).isNotNull()).over(pix), F.lit(False))
    g = g.withColumn("__land", land)
    g = with_drought_indices(g, decimals)
    g = series_drought(g, "ndvi", "drought_ndvi", decimals)
    g = g.withColumns({"drought_spi": threshold_flag("spi"), "drought_spei": threshold_flag("spei")})
    g = g.withColumns({f: F.col(f) & F.col("__land") for f in FLAGS})
    # P14 drop the final step, W6 flip precip, P17 sea mask, P5 sentinels
    g = g.where(F.col("time") < F.col("__t1"))
    if "precip" in variables:
        g = g.withColumn("precip", flip_in_pairs(g, "precip"))
    g = g.withColumns({v: F.when(F.col("__land"), F.col(v)) for v in variables})
    g = mask_sentinel(g, [v for v in variables if "lst" in v])
    return g.select("lat", "lon", "time", "t_idx", PIXEL_ID, *variables, *FLAGS)


def drought_lag_sets(grid: DataFrame, mask_var: str = "sm", start_ts: int = 4,
                     variables: Sequence[str] = GRID_VARS, flag: str = "drought_ndvi",
                     decimals: int | None = None) -> DataFrame:
    """Rows at calendar index >= ``start_ts`` with ``{var}_t0..t3`` and
    ``in_drought``; filter on the flag for either polarity (P24)."""
    ds = read_and_mask(grid, mask_var, variables, decimals)
    lags = lag_stack(ds, list(variables), 3)
    out = lags.where(F.col("t_idx") >= start_ts).withColumn("in_drought", F.col(flag))
    cols = ["lat", "lon", "time"] + [f"{v}_t{k}" for v in variables for k in range(4)] + ["in_drought"]
    return out.select(*cols)
