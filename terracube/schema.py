"""Column names shared by the pipeline.

Fixed values (must equal the reference pipeline for the same results):
    key columns:        lat, lon, time, gb_year, gb_month
    model features:     lst_night, lst_day, precip, sm, ndvi, evi, ndvi_anomaly
    vegetation inputs:  ndvi, evi, ndvi_anomaly
    LST variables:      lst_night, lst_day (missing data coded as 200)
"""

PIXEL = ["lat", "lon"]
CUBE_KEYS = ["lat", "lon", "time"]
KEY_COLS = ["lat", "lon", "time", "gb_year", "gb_month"]
VALUE_COLS = ["lst_night", "lst_day", "precip", "sm", "ndvi", "evi", "ndvi_anomaly"]
VEGETATION_LABELS = ["ndvi", "evi", "ndvi_anomaly"]
LST_COLS = ["lst_night", "lst_day"]
LST_SENTINEL = 200.0
GRID_VARS = ["lst_day", "lst_night", "precip", "sm", "ndvi", "evi"]


PIXEL_ID = "__pix"


def pixel_keys(df) -> list:
    """Partition keys for pixel-local windows.

    When the cube carries the integer pixel hash added by
    ``cluster_by_pixel``, it leads the keys: a hash partitioning on it then
    satisfies every pixel-local window without another exchange (Spark
    normalises floating-point window keys, so partitioning on the raw
    lat/lon doubles would not).  lat and lon stay in the keys, so a hash
    collision can never merge two pixels.
    """
    return [PIXEL_ID, *PIXEL] if PIXEL_ID in df.columns else list(PIXEL)


def value_columns(df, keys=CUBE_KEYS):
    """Variable discovery (P34): every non-key column of a cube."""
    return [c for c in df.columns if c not in keys and c != PIXEL_ID]
