"""The clean pipeline as one lazy plan.

scan -> relative year/month (narrow) -> LST sentinel mask (narrow) ->
anomaly (one shuffle on pixel-month) -> drop incomplete rows -> project ->
target copy -> z-score (one global partial aggregate, broadcast back).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from terracube.functions.time import with_relative_time
from terracube.operators.clean import (anomaly, cluster_by_pixel, copy_target, drop_incomplete,
                                       mask_lst, normalising_stats, zscore)
from terracube.schema import KEY_COLS, PIXEL_ID, VALUE_COLS


@dataclass(frozen=True)
class CleanParams:
    pred_month: int = 6
    target: str = "ndvi"
    clim_before_year: int = 2016


def clean_cube(raw: DataFrame, p: CleanParams = CleanParams()) -> DataFrame:
    """Rows of KEY_COLS + VALUE_COLS that survive the null rule, raw units."""
    df = with_relative_time(cluster_by_pixel(raw), p.pred_month)
    df = mask_lst(df)
    df = anomaly(df, "ndvi", "ndvi_anomaly", clim_before_year=p.clim_before_year)
    df = drop_incomplete(df)  # over every merged column, before projection
    # the pixel hash travels on so later pixel-local windows reuse the exchange
    return df.select(*KEY_COLS, *VALUE_COLS, *([PIXEL_ID] if PIXEL_ID in df.columns else []))


def clean_and_scale(raw: DataFrame, p: CleanParams = CleanParams()) -> tuple[DataFrame, DataFrame]:
    """Returns (scaled rows with raw-unit ``target``, normalising stats)."""
    rows = copy_target(clean_cube(raw, p), p.target, VALUE_COLS)
    stats = normalising_stats(rows, VALUE_COLS)
    return zscore(rows, VALUE_COLS, stats), stats
