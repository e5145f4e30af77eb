"""Harmonisation pipelines (J7, C1-C5): bring products onto the reference
calendar and grid, then merge.

Each stage is a DataFrame operator. The regrid weight tables come from the raw
product's axes and the reference's, so the resampled cube is planned once, and
all checks are filters of the lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.functions.time import trunc_ntz
from terracube.operators.conform import check_same_grid, normalise_coordinate_names, rename_variables
from terracube.operators.masks import apply_mask, monthly_drought, reference_mask, threshold_flag
from terracube.operators.merge import merge_cubes
from terracube.operators.regrid import axis, regrid_bilinear, regrid_nearest
from terracube.operators.reproject import Projection, reproject
from terracube.operators.resample import resample_first, resample_median
from terracube.operators.slicing import (bbox_from_reference, select_east_africa, time_slice, time_slice_exact,
                                         time_slice_from_reference)
from terracube.operators.units import MM_MONTH_TO_MM_DAY, WM2_TO_MM_DAY, mean_of
from terracube.schema import value_columns
from terracube.sources.layout import guarded_write, read_guarded


def _axes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return axis(df, "lat"), axis(df, "lon")


def to_reference_grid(reference: DataFrame, product: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """Rename -> month-start median -> time slice -> bilinear -> box -> checks,
    for all of the product's variables at once."""
    raw = normalise_coordinate_names(product)
    names = list(variables or value_columns(raw))
    p = time_slice_from_reference(reference, resample_median(raw, ["lat", "lon"], names))
    months = time_slice_from_reference(reference, raw.select(trunc_ntz("month", "time").alias("time")).distinct())
    src_lat, src_lon = _axes(raw)
    p = regrid_bilinear(p, *_axes(reference), names, src_lat=src_lat, src_lon=src_lon, times=months)
    return check_same_grid(reference, bbox_from_reference(reference, p))


def harmonise_script(reference: DataFrame, products: Sequence[DataFrame], lo: str, hi: str) -> DataFrame:
    """The reference is sliced and resampled; each product is resampled (first
    value, month-end), sliced and regridded to the nearest cell; all variables merge."""
    ref = time_slice(normalise_coordinate_names(reference), lo, hi)
    ref = resample_first(ref, ["lat", "lon"], value_columns(ref))
    out = []
    for product in products:
        raw = normalise_coordinate_names(product)
        names = value_columns(raw)
        p = time_slice(resample_first(raw, ["lat", "lon"], names), lo, hi)
        src_lat, src_lon = _axes(raw)
        out.append(regrid_nearest(p, *_axes(reference), names, src_lat=src_lat, src_lon=src_lon))
    return merge_cubes(ref, *out)


def harmonise_to_reference(reference: DataFrame, products: Mapping[str, tuple[DataFrame, str]], drought: bool = False,
                           decimals: int | None = None) -> DataFrame:
    """J7 on every product (``name: (cube, variable)``), merge with the reference,
    derived ``lst_mean`` (P26) and, with ``drought``, the three drought flags (P23, A9).

    Variables that come from one cube are resampled and regridded together."""
    shared: dict[int, tuple[DataFrame, dict]] = {}
    for name, (cube, var) in products.items():
        shared.setdefault(id(cube), (cube, {}))[1][var] = name
    cubes = [to_reference_grid(reference, rename_variables(cube, names), list(names.values())) for cube, names in shared.values()]
    m = mean_of(merge_cubes(reference, *cubes), "lst_mean", "lst_day", "lst_night")
    if not drought:
        return m
    m = m.withColumns({"drought_spei": threshold_flag("spei"), "drought_spi": threshold_flag("spi")})
    return monthly_drought(m, "ndvi", "drought_ndvi", decimals=decimals)


def common_calendar(reference: DataFrame, product: DataFrame) -> DataFrame:
    """The reference's rows within the product's months, so that P12 compares what both cover."""
    bound = lambda f: product.agg(f("time")).scalar()
    return reference.where((F.col("time") >= bound(F.min)) & (F.col("time") <= bound(F.max)))


def _first_of_month(product: DataFrame, var: str) -> tuple[DataFrame, DataFrame]:
    raw = normalise_coordinate_names(product)
    p = resample_first(raw, ["lat", "lon"], var)
    return raw, p.withColumn("time", trunc_ntz("month", "time"))  # month-end date -> month start


def rainfall_cleaner(reference: DataFrame, product: DataFrame, var: str = "value", mask_var: str = "sm",
                     path: str | None = None, force: bool = False) -> DataFrame:
    """First per month -> exact slice -> mm/month to mm/day -> rename
    coordinates -> bilinear -> reference null mask -> rename to ``precip`` -> guarded sink."""
    raw, p = _first_of_month(product, var)
    months = raw.select(trunc_ntz("month", "time").alias("time")).distinct()
    ref = common_calendar(reference, months)
    p = time_slice_exact(ref, p)
    p = p.withColumn(var, F.col(var) / F.lit(MM_MONTH_TO_MM_DAY))
    src_lat, src_lon = _axes(raw)
    p = regrid_bilinear(p, *_axes(reference), [var], src_lat=src_lat, src_lon=src_lon, times=ref.select("time"))
    p = apply_mask(p, reference_mask(reference, mask_var, t_index=0), [var], "masked", keep_when=False)
    return _sunk(rename_variables(p, {var: "precip"}), path, force)


def evaporation_cleaner(reference: DataFrame, product: DataFrame, var: str = "value", mask_var: str = "sm",
                        path: str | None = None, force: bool = False) -> DataFrame:
    """C4: first per month -> exact slice -> W/m2 to mm/day -> nearest regrid
    -> reference null mask -> rename to ``evaporation`` -> guarded sink."""
    raw, p = _first_of_month(product, var)
    months = raw.select(trunc_ntz("month", "time").alias("time")).distinct()
    p = time_slice_exact(common_calendar(reference, months), p)
    p = p.withColumn(var, F.col(var) / F.lit(WM2_TO_MM_DAY))
    src_lat, src_lon = _axes(raw)
    p = regrid_nearest(p, *_axes(reference), [var], src_lat=src_lat, src_lon=src_lon)
    p = apply_mask(p, reference_mask(reference, mask_var, t_index=0), [var], "masked", keep_when=False)
    return _sunk(rename_variables(p, {var: "evaporation"}), path, force)


def reference_cleaner(product: DataFrame, var: str = "value", name: str = "holaps_evapotranspiration", path: str | None = None, force: bool = True,
                      projection: Projection | None = None, resolution: float = 0.25, sum_decimals: int | None = None) -> DataFrame:
    """Reprojection of a product with ``x, y`` in metres (with ``projection``) -> fixed box (P10)
    -> W/m2 to mm/day (P27) -> rename (P2) -> first per month (A4) -> forced sink (S8)."""
    p = product if projection is None else reproject(product, projection, resolution, [var], sum_decimals=sum_decimals)
    p = select_east_africa(normalise_coordinate_names(p).select("lat", "lon", "time", var))
    p = rename_variables(p.withColumn(var, F.col(var) / F.lit(WM2_TO_MM_DAY)), {var: name})
    return _sunk(resample_first(p, ["lat", "lon"], name), path, force)


def _sunk(df: DataFrame, path: str | None, force: bool) -> DataFrame:
    """S8 when a path is given: the written cube read back."""
    if path is None:
        return df
    guarded_write(df, path, force)
    return read_guarded(df.sparkSession, path, df.columns)
