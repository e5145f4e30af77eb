"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Parameters for the driver tables (derived grid spans 1995-01..2001-11):
prediction month 6, climatology years < 2001, test year 2001, target ndvi.
Computed doubles are rounded to 6 decimals so that engines agree.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracube.functions.lookup import LANDCOVER
from terracube.operators import masks as MK
from terracube.operators import metrics as MT
from terracube.operators import slicing as SL
from terracube.operators import stats as S
from terracube.functions.time import parse_time, trunc_ntz
from terracube.operators.conform import normalise_coordinate_names
from terracube.operators.clean import climatology, denormalise, mask_sentinel, normalising_stats, subtract_climatology
from terracube.operators.lookup import bands_to_time, classify_landcover, clip_to_regions, time_axis
from terracube.operators.masks import all_valid
from terracube.operators.merge import merge_cubes
from terracube.operators.regrid import axis, regrid_bilinear, regrid_nearest
from terracube.operators.reproject import geostationary, reproject, sinusoidal
from terracube.operators.resample import densify, infer_freq, relabel_by_position, resample_first, resample_median
from terracube.operators.windows import count_pixel_years, flip_lat, shift_time
from terracube.plans import harmonise as HM
from terracube.plans import models as ML
from terracube.plans import networks as NN
from terracube.plans import trees as TR
from terracube.plans.clean import CleanParams, clean_and_scale, clean_cube
from terracube.plans.engineer import engineer_arrays, engineer_steps, example_summary
from terracube.plans.verify import verification_frame
from terracube.schema import GRID_VARS, KEY_COLS, VALUE_COLS
from terracube.sources import io as IO
from terracube.sources import layout as LY
from terracube.sources import tiles as TL
from terracube.sources.grid import daily_series, load_daily_product, load_grid

PARAMS = CleanParams(pred_month=6, target="ndvi", clim_before_year=2001)
TEST_YEAR = 2001

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(*cols: str) -> list:
    # + 0.0 turns a rounded -0.0 into 0.0 so engines agree bit for bit
    return [(F.round(c, 6) + F.lit(0.0)).alias(c) for c in cols]


def fixed6(c: str):
    """Half-up to 6 decimals after snapping to 1e-10, from IEEE operations
    only (multiply, add, floor, divide), so every engine returns the same
    bits even for values that sit exactly on a rounding tie.  Larger values than
    the snap can carry (1e5) raise."""
    snapped = F.floor(F.when(F.abs(c) < 1e5, F.col(c)).when(F.col(c).isNotNull(), F.raise_error(F.lit("fixed6 needs |x| < 1e5")).cast("double")) * F.lit(1e10) + F.lit(0.5))
    return (F.floor(snapped / F.lit(1e4) + F.lit(0.5)) / F.lit(1e6)).alias(c)


def _steps(spark, sf_dir):
    scaled, _ = clean_and_scale(load_grid(spark, sf_dir), PARAMS)
    return engineer_steps(scaled, TEST_YEAR)


@register("example_summary")
def q_example_summary(spark, sf_dir):
    return example_summary(_steps(spark, sf_dir))


@register("cube_clean")
def q_cube_clean(spark, sf_dir):
    df = clean_cube(load_grid(spark, sf_dir), PARAMS)
    return df.select(*[c for c in KEY_COLS], *[c for c in VALUE_COLS if c != "ndvi_anomaly"],
                     F.round("ndvi_anomaly", 6).alias("ndvi_anomaly"))


@register("normalising_stats")
def q_normalising_stats(spark, sf_dir):
    st = normalising_stats(clean_cube(load_grid(spark, sf_dir), PARAMS), VALUE_COLS)
    return st.select("variable", *r6("mean", "std"))


@register("zscore")
def q_zscore(spark, sf_dir):
    scaled, _ = clean_and_scale(load_grid(spark, sf_dir), PARAMS)
    return scaled.select(*KEY_COLS, "target", *r6(*VALUE_COLS))


@register("pixel_year_examples")
def q_pixel_year_examples(spark, sf_dir):
    s = _steps(spark, sf_dir)
    return s.select("lat", "lon", "gb_year", "split", "step", *r6(*VALUE_COLS), "y")


# ---------------------------------------------------------------- statistics

CLIM_YEAR = 2001


def _masked_grid(spark, sf_dir):
    return mask_sentinel(load_grid(spark, sf_dir))


@register("climatology")
def q_climatology(spark, sf_dir):
    c = climatology(load_grid(spark, sf_dir), "ndvi", CLIM_YEAR)
    return c.select("lat", "lon", "month", *r6("ndvi_clim"))


@register("anomaly")
def q_anomaly(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    a = subtract_climatology(g, climatology(g, "ndvi", CLIM_YEAR), "ndvi")
    return a.select("lat", "lon", "time", *r6("ndvi_anomaly"))


@register("seasonal_max")
def q_seasonal_max(spark, sf_dir):
    return S.seasonal_max(load_grid(spark, sf_dir), "ndvi").select("month", *r6("ndvi_max_monthly_mean"))


@register("time_mean")
def q_time_mean(spark, sf_dir):
    return S.time_mean(_masked_grid(spark, sf_dir), GRID_VARS, sum_decimals=6)


@register("describe")
def q_describe(spark, sf_dir):
    from terracube.schema import value_columns
    g = _masked_grid(spark, sf_dir)
    d = S.describe(g, value_columns(g), sum_decimals=6)  # P34: every variable of the cube
    return d.select("variable", "count", "mean", *r6("std", "min", "q25", "q50", "q75", "max"))


@register("quantiles")
def q_quantiles(spark, sf_dir):
    return S.quantiles(load_grid(spark, sf_dir), "ndvi").select("q", *r6("quantile"))


@register("histogram")
def q_histogram(spark, sf_dir):
    return S.histogram(load_grid(spark, sf_dir), "ndvi", 40).select("bucket", "count", *r6("edge_lo"))


@register("distinct_counts")
def q_distinct_counts(spark, sf_dir):
    return S.distinct_counts(load_grid(spark, sf_dir))


@register("percentile_normalise")
def q_percentile_normalise(spark, sf_dir):
    pn = S.percentile_normalise(load_grid(spark, sf_dir), "ndvi", 95.0)
    return pn.select("lat", "lon", "time", *r6("ndvi_pn"))


@register("unit_convert")
def q_unit_convert(spark, sf_dir):
    from terracube.operators.units import convert_units, mean_of
    g = mean_of(_masked_grid(spark, sf_dir), "lst_mean", "lst_day", "lst_night")
    g = convert_units(g)
    return g.select("lat", "lon", "time", *r6("lst_mean", "precip_mm_day", "evi_mm_day", "sm_rescaled"))


# ----------------------------------------------------------------- resample


@register("resample_median")
def q_resample_median(spark, sf_dir):
    m = resample_median(daily_series(spark, sf_dir), ["user_id"], "value")
    return m.select("user_id", "time", *r6("value"))


@register("resample_first")
def q_resample_first(spark, sf_dir):
    from terracube.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("time"), "value")
    return resample_first(ev, ["user_id"], "value")


@register("calendar_densify")
def q_calendar_densify(spark, sf_dir):
    return densify(load_grid(spark, sf_dir).select("lat", "lon", "time", "ndvi"))


@register("relabel_calendar")
def q_relabel_calendar(spark, sf_dir):
    """A22 ``ensure_same_time``: month ends of the product take the grid's month starts by position."""
    p = normalise_coordinate_names(load_daily_product(spark, sf_dir))
    p = resample_first(p, ["lat", "lon"], "value")
    return relabel_by_position(load_grid(spark, sf_dir), p)


@register("infer_freq")
def q_infer_freq(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    a = infer_freq(g).withColumn("source", F.lit("grid"))
    b = infer_freq(daily_series(spark, sf_dir)).withColumn("source", F.lit("events_daily"))
    c = infer_freq(g.select(F.last_day("time").cast("timestamp_ntz").alias("time"))).withColumn("source", F.lit("grid_month_end"))
    return a.unionByName(b).unionByName(c).select("source", "freq", "n_steps")


# ------------------------------------------------------------------- regrid


def _target_axes(g):
    return (axis(g, "lat").select((F.col("v") + 0.125).alias("v")),
            axis(g, "lon").select((F.col("v") + 0.1).alias("v")))


@register("regrid_nearest")
def q_regrid_nearest(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    la, lo = _target_axes(g)
    return regrid_nearest(g, la, lo, ["ndvi", "precip"]).select(
        *r6("lat", "lon"), "time", "ndvi", "precip")


@register("regrid_bilinear")
def q_regrid_bilinear(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    la, lo = _target_axes(g)
    return regrid_bilinear(g, la, lo, ["ndvi", "sm"]).select(
        *r6("lat", "lon"), "time", *r6("ndvi", "sm"))


# -------------------------------------------------------------------- merge


@register("merge_cubes")
def q_merge_cubes(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    a = g.where(F.col("time") < F.lit("2000-01-01").cast("timestamp_ntz")).select("lat", "lon", "time", "lst_day", "lst_night")
    b = g.where(F.col("time") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("lat", "lon", "time", "precip", "ndvi")
    m = merge_cubes(a, b)
    return all_valid(m, ["lst_day", "precip", "ndvi"], "ndvi", "ndvi_all_valid")


# ------------------------------------------------------------------ slicing


@register("bbox_slice")
def q_bbox_slice(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    ref = SL.bbox(g, 0.25, 0.75, 1.0, 3.0).select("lat", "lon")
    return SL.bbox_from_reference(ref, g).select("lat", "lon", "time", "ndvi")


@register("time_slice")
def q_time_slice(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    ref = SL.time_slice(g, "1999-01-01", "1999-12-31").select("time")
    return SL.time_slice_from_reference(ref, g).select("lat", "lon", "time", "precip")


@register("drop_last_step")
def q_drop_last_step(spark, sf_dir):
    return SL.drop_last_step(load_grid(spark, sf_dir)).select("lat", "lon", "time", "evi")


@register("isel_time")
def q_isel_time(spark, sf_dir):
    return SL.isel(load_grid(spark, sf_dir), "time", 5).select("lat", "lon", "time", "ndvi")


@register("isel_axes")
def q_isel_axes(spark, sf_dir):
    """P15 on space: second latitude, last longitude."""
    return SL.isel(SL.isel(load_grid(spark, sf_dir), "lat", 1), "lon", -1).select("lat", "lon", "time", "ndvi")


@register("fixed_box")
def q_fixed_box(spark, sf_dir):
    """P10: the fixed region; the grid's longitudes are moved to its west edge."""
    g = load_grid(spark, sf_dir).withColumn("lon", F.col("lon") + 30.0)
    return SL.select_east_africa(g).select("lat", "lon", "time", "ndvi")


# -------------------------------------------------------------------- masks


@register("land_mask")
def q_land_mask(spark, sf_dir):
    return MK.land_mask(load_grid(spark, sf_dir), "sm", 1)


@register("sea_pixels")
def q_sea_pixels(spark, sf_dir):
    return MK.sea_pixels(MK.land_mask(load_grid(spark, sf_dir), "sm", 1))


@register("reference_mask")
def q_reference_mask(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    m = MK.reference_mask(g, "sm", t_index=0)
    out = MK.apply_mask(g.select("lat", "lon", "time", "precip"), m, ["precip"], "masked", keep_when=False)
    return out


TIES = 9


@register("mask_to_boolean")
def q_mask_to_boolean(spark, sf_dir):
    """Numeric masks (1, 0, missing) to boolean."""
    g = load_grid(spark, sf_dir).withColumn("m", F.floor(F.col("sm") * 1000) % 2)
    return MK.to_boolean(g, ["m"]).select("lat", "lon", "time", "m")


@register("drought_masks")
def q_drought_masks(spark, sf_dir):
    from terracube.plans.drought import with_drought_indices
    # 9 decimals, so that a last bit of a mean cannot flip a tie between engines
    g = with_drought_indices(load_grid(spark, sf_dir), TIES)
    g = MK.monthly_drought(g, "ndvi", "drought_ndvi_month", decimals=TIES)
    g = MK.series_drought(g, "ndvi", "drought_ndvi_series", decimals=TIES)
    g = g.withColumns({"drought_spi": MK.threshold_flag("spi"), "drought_spei": MK.threshold_flag("spei"),
                       "not_drought": MK.invert("drought_ndvi_month")})
    return g.select("lat", "lon", "time", (F.col("spi") + 0.0).alias("spi"), (F.col("spei") + 0.0).alias("spei"),
                    "drought_spi", "drought_spei",
                    "drought_ndvi_month", "drought_ndvi_series", "not_drought")


@register("drought_lags")
def q_drought_lags(spark, sf_dir):
    from terracube.plans.drought import drought_lag_sets
    return drought_lag_sets(load_grid(spark, sf_dir), decimals=TIES)


# ------------------------------------------------------------ shift and flip


@register("shift")
def q_shift(spark, sf_dir):
    g = load_grid(spark, sf_dir).select("lat", "lon", "time", "precip")
    g = g.withColumn("precip_prev", F.col("precip")).withColumn("precip_next", F.col("precip"))
    g = shift_time(g, ["precip_prev"], 1)
    return shift_time(g, ["precip_next"], -1)


@register("flip_lat")
def q_flip_lat(spark, sf_dir):
    return flip_lat(load_grid(spark, sf_dir).select("lat", "lon", "time", "precip"), ["precip"])


# ------------------------------------------------------------ bands, lookup


@register("band_unpivot")
def q_band_unpivot(spark, sf_dir):
    """J8 over every time step; the bands are made by pivoting on the step number."""
    g = load_grid(spark, sf_dir)
    times = time_axis(g)
    n = times.count()  # calendar length: one band column per step
    wide = (g.join(times, "time").groupBy("lat", "lon").pivot("idx", list(range(1, n + 1))).agg(F.first("precip"))
              .withColumnsRenamed({str(i): f"Band{i}" for i in range(1, n + 1)}))
    return bands_to_time(wide, times, ["lat", "lon"], "precip")


@register("class_lookup")
def q_class_lookup(spark, sf_dir):
    from terracube.sources.tables import read_table
    codes = F.array(*[F.lit(c[0]) for c in LANDCOVER])
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.element_at(codes, (F.col("p_size") % len(LANDCOVER)) + 1).alias("code"))
    return classify_landcover(part)


@register("class_inversion")
def q_class_inversion(spark, sf_dir):
    """integer class id back to its name."""
    from terracube.functions.lookup import class_id_to_name
    from terracube.sources.tables import read_table
    part = read_table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 15).alias("class_id"))
    return part.join(F.broadcast(class_id_to_name(spark)), "class_id", "left").select("p_partkey", "class_id", "class")


# Fixed test regions over the derived grid (rings of lon, lat; the second ring of a region is a hole).
REGIONS = [
    ("north", [[(0.1, -0.1), (8.0, 0.4), (0.1, 1.1)], [(0.6, 0.2), (2.2, 0.4), (0.6, 0.7)]]),
    ("south", [[(3.0, 0.3), (9.9, -0.2), (9.9, 1.2), (5.0, 0.9)]]),
]


def regions_frame(spark):
    return spark.createDataFrame(
        [(n, [[{"lon": x, "lat": y} for x, y in ring] for ring in rings]) for n, rings in REGIONS],
        "country string, rings array<array<struct<lon:double,lat:double>>>")


@register("clip_polygon")
def q_clip_polygon(spark, sf_dir):
    from terracube.functions.geo import with_point
    pts = with_point(load_grid(spark, sf_dir).select("lat", "lon").distinct())
    c = clip_to_regions(pts, regions_frame(spark))
    return c.select("lat", "lon", "country")


# ------------------------------------------------------------- verification

METRICS = ["rmse", "explained_variance", "r2", "pct_bias"]


@register("verification")
def q_verification(spark, sf_dir):
    v = MT.verify(verification_frame(load_grid(spark, sf_dir)), sum_decimals=6)
    return v.select("n", "mae", *r6(*METRICS))


@register("verification_gaps")
def q_verification_gaps(spark, sf_dir):
    """A15-A19 where predictions and truths are missing in places."""
    g = load_grid(spark, sf_dir).select("lat", "lon", "time", F.col("sm").alias("y"), F.col("sm").alias("prediction"))
    v = MT.verify(shift_time(g, ["prediction"], 1), sum_decimals=6)
    return v.select("n", "mae", *r6(*METRICS))


@register("band_metrics")
def q_band_metrics(spark, sf_dir):
    v = verification_frame(load_grid(spark, sf_dir))
    b = MT.quantile_bands(v).where(F.col("band").isNotNull())
    return MT.verify(b, by=["band"], sum_decimals=6).select("band", "n", "mae", *r6(*METRICS))


@register("error_mask")
def q_error_mask(spark, sf_dir):
    e = MT.error_map(verification_frame(load_grid(spark, sf_dir)))
    m = MT.error_quantile_mask(e, 0.9, above=True)
    return m.select("lat", "lon", "time", *r6("difference"))


# ------------------------------------------------------------------- models
# Fitted values are checked by what holds for every correct fit: the normal
# equations, additivity, and error below that of the mean.


def _examples(spark, sf_dir):
    scaled, stats = clean_and_scale(load_grid(spark, sf_dir), PARAMS)
    return ML.materialise(engineer_arrays(scaled, TEST_YEAR)), stats


def _fit_report(ex, hide=False):
    preds, _, _ = ML.linear_fit_score(ex, hide)
    data = ML.hide_features(ex, list(VALUE_COLS), ML.VEGETATION_LABELS) if hide else ex
    residual = ML.normal_residual(preds, data).select(F.round("residual", 4) + 0.0).scalar()
    scored = ML.evaluate(preds).select("split", "n", *r6("rmse"))
    return scored.withColumn("normal_residual", F.when(F.col("split") == "train", residual))


@register("linear_fit_score")
def q_linear_fit_score(spark, sf_dir):
    ex, _ = _examples(spark, sf_dir)
    return _fit_report(ex).select("split", "n", "normal_residual")


@register("ablation")
def q_ablation(spark, sf_dir):
    """M3/M4: error of the linear fit per split, with and without vegetation inputs."""
    ex, _ = _examples(spark, sf_dir)
    both = [_fit_report(ex, hide).withColumn("variant", F.lit(name)) for name, hide in (("all_features", False), ("no_vegetation", True))]
    return both[0].unionByName(both[1]).select("variant", "split", "n", "rmse", "normal_residual")


def model_errors(spark, sf_dir):
    """M3: error measures per split, with and without vegetation inputs, and of the trees
    (reported by the benchmark)."""
    ex, _ = _examples(spark, sf_dir)
    linear = ML.ablation(ex).select("variant", "split", "n", *r6("rmse"))
    trees = ML.evaluate(ML.nonlinear_fit_score(ex)).withColumn("variant", F.lit("trees"))
    return linear.unionByName(trees.select("variant", "split", "n", *r6("rmse")))


def fitted_top10(spark, sf_dir):
    """The ten largest coefficients of the linear fit."""
    ex, _ = _examples(spark, sf_dir)
    _, model, feats = ML.linear_fit_score(ex)
    return ML.top_k_abs(ML.coefficients(model, feats, spark), "value", 10)


@register("coef_top10")
def q_coef_top10(spark, sf_dir):
    return fitted_top10(spark, sf_dir).select("feature", (F.round("value", 4) + 0.0).alias("value"))


@register("mean_input_top10")
def q_mean_input_top10(spark, sf_dir):
    """The ten largest mean inputs of the train split under their coefficient labels."""
    ex, _ = _examples(spark, sf_dir)
    labels = F.array(*[F.lit(x) for x in ML.feature_labels(VALUE_COLS)])
    means = ex.where("split = 'train'").select(F.posexplode(F.flatten("x")).alias("j", "v")).groupBy("j").agg(F.avg("v").alias("value"))
    means = means.select(F.element_at(labels, F.col("j") + 1).alias("feature"), F.round("value", 6).alias("value"))
    return ML.top_k_abs(means, "value", 10).select("feature", (F.col("value") + 0.0).alias("value"))


@register("nonlinear_fit_score")
def q_nonlinear_fit_score(spark, sf_dir):
    ex, _ = _examples(spark, sf_dir)
    preds = ML.nonlinear_fit_score(ex)
    better = F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))) < F.stddev_pop("y")
    return preds.groupBy("split").agg(F.count("prediction").alias("n"), better.alias("beats_mean")).select(
        "split", "n", F.when(F.col("split") == "train", F.col("beats_mean")).alias("beats_mean"))


@register("linear_attribution")
def q_linear_attribution(spark, sf_dir):
    """Per test example, the number of attributions and how far their sum is from
    prediction minus base (a constant), which is 0."""
    ex, stats = _examples(spark, sf_dir)
    preds, model, _ = ML.linear_fit_score(ex)
    keys = ["lat", "lon", "gb_year"]
    sums = ML.linear_attribution(ex, stats, model=model).groupBy(*keys).agg(F.count("attribution").alias("n"), F.sum("attribution").alias("s"))
    each = sums.join(preds.select(*keys, "prediction"), keys).withColumn("base", F.col("prediction") - F.col("s"))
    lowest = each.agg(F.min("base")).scalar()
    return each.select(*keys, "n", (F.round(F.col("base") - lowest, 6) + 0.0).alias("residual"))


@register("early_stop")
def q_early_stop(spark, sf_dir):
    """M6: trees validated after every tree; what was kept is the best of all stages that were looked at."""
    ex, _ = _examples(spark, sf_dir)
    kept, errors, _ = TR.fit_boosted(ex, IO.scratch_path(spark, "trees"))
    n = len(kept.trees)
    seen = errors[: n + 3]  # until three stages without a gain
    better = F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))) < F.stddev_pop("y")
    report = TR.score_trees(ex, kept).groupBy("split").agg(F.count("prediction").alias("n"), better.alias("beats_mean"))
    return report.select("split", "n", F.when(F.col("split") == "train", F.col("beats_mean")).alias("beats_mean"), F.lit(errors[n - 1] == min(seen)).alias("best_is_least"),
                         F.lit(len(seen) - n == min(3, len(errors) - n)).alias("waited"))


def _additive(attributions, predictions):
    """Per example: the number of attributions, and prediction minus base minus their sum, which is 0."""
    keys = ["lat", "lon", "gb_year"]
    sums = attributions.groupBy(*keys).agg(F.count("attribution").alias("n"), F.sum("attribution").alias("s"), F.max("base").alias("base"))
    each = sums.join(predictions.select(*keys, "prediction"), keys)
    return each.select(*keys, "n", (F.round(F.col("prediction") - F.col("base") - F.col("s"), 6) + 0.0).alias("residual"))


@register("tree_attribution")
def q_tree_attribution(spark, sf_dir):
    """Shapley values of the boosted trees, against the predictions of the fitted model itself."""
    ex, stats = _examples(spark, sf_dir)
    path = IO.scratch_path(spark, "trees")
    _, _, model = TR.fit_boosted(ex, path)
    test = ex.where("split = 'test'")
    return _additive(TR.tree_attribution(test, TR.load_ensemble(spark, path, model.treeWeights), stats), ML.score(model, ML.prepare(test)[0]))


@register("network_attribution")
def q_network_attribution(spark, sf_dir):
    """Gradients of the network integrated against 500 background rows."""
    ex, stats = _examples(spark, sf_dir)
    weights, test = rule_weights("ffn", len(VALUE_COLS)), ex.where("split = 'test'")
    background = ML.background_sample(ex.where("split = 'train'").select("lat", "lon", "gb_year", "x"))
    return _additive(NN.network_attribution(test, weights, background, stats), ML.score_network(test, "ffn", len(VALUE_COLS), weights=weights))


@register("network_fit_score")
def q_network_fit_score(spark, sf_dir):
    """M5: the network trained on the train split, scored on both."""
    ex, _ = _examples(spark, sf_dir)
    weights, errors = NN.train_network(ex, IO.scratch_path(spark, "network"), epochs=12, rate=0.05, steps=8)
    preds = ML.score_network(ex, "ffn", len(VALUE_COLS), weights=weights).join(ex.select("lat", "lon", "gb_year", "split"), ["lat", "lon", "gb_year"])
    better = F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))) < F.stddev_pop("y")
    return preds.groupBy("split").agg(F.count("prediction").alias("n"), better.alias("beats_mean")).select(
        "split", "n", F.when(F.col("split") == "train", F.col("beats_mean")).alias("beats_mean"), F.lit(min(errors) < errors[0]).alias("learned"))


def rule_weights(kind, n_features, hidden=3):
    """Closed-form weight sets, so that the forward passes can be checked in SQL."""
    def rule(rows, cols, a, b):
        return np.array([[((i * a + j * b) % 11 - 5) / 50 for j in range(cols)] for i in range(rows)])

    if kind == "ffn":
        n = n_features * 11
        return {"w1": rule(n, n, 7, 3), "gamma": np.ones(n), "beta": np.zeros(n), "mean": np.zeros(n), "var": np.ones(n),
                "eps": 1e-5, "w2": rule(1, n, 1, 5), "b2": np.array([0.25])}
    w = {f"W{g}": rule(hidden, n_features + hidden, k + 2, k + 3) for k, g in enumerate("fuco")}
    w |= {f"b{g}": np.full(hidden, 0.1 * (k + 1)) for k, g in enumerate("fuco")}
    return w | {"D1": rule(2, hidden, 3, 4), "d1": np.array([0.1, 0.2]), "D2": rule(1, 2, 1, 2), "d2": np.array([0.3]), "n_dense": 2}


def _scored(spark, sf_dir, kind):
    ex, _ = _examples(spark, sf_dir)
    path = IO.scratch_path(spark, f"weights-{kind}")
    ML.save_weights(spark, rule_weights(kind, len(VALUE_COLS)), path)
    out = ML.score_network(ex, kind, len(VALUE_COLS), weights=ML.load_weights(spark, path))
    return out.select("lat", "lon", "gb_year", "y", *r6("prediction"))


@register("ffn_score")
def q_ffn_score(spark, sf_dir):
    return _scored(spark, sf_dir, "ffn")


@register("rnn_score")
def q_rnn_score(spark, sf_dir):
    return _scored(spark, sf_dir, "rnn")


@register("denormalise")
def q_denormalise(spark, sf_dir):
    """Scaled values back to raw units."""
    scaled, stats = clean_and_scale(load_grid(spark, sf_dir), PARAMS)
    long = S.long_values(scaled, VALUE_COLS, KEY_COLS[:3])
    return denormalise(long, stats).select("lat", "lon", "time", "variable", *r6("value_raw"))


# ---------------------------------------------------------------- harmonise


# Slice of C1 (P13): the script's range falls inside the data and inside a month.
SCRIPT_RANGE = ("1995-02-14", "2001-09-01")


@register("harmonise_script")
def q_harmonise_script(spark, sf_dir):
    g = load_grid(spark, sf_dir)
    daily = load_daily_product(spark, sf_dir)
    lst = g.select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "time", "lst_day", "lst_night")
    return HM.harmonise_script(g.select("lat", "lon", "time", "precip", "ndvi"), [daily, lst], *SCRIPT_RANGE)


@register("harmonise_bilinear")
def q_harmonise_bilinear(spark, sf_dir):
    from terracube.plans.drought import with_drought_indices
    ref = with_drought_indices(load_grid(spark, sf_dir), TIES).select("lat", "lon", "time", "lst_day", "lst_night", "ndvi", "spi", "spei")
    daily = load_daily_product(spark, sf_dir)
    # P35 wants equal calendars: the months that both have
    ref = HM.common_calendar(ref, daily.select(trunc_ntz("month", "time").alias("time")))
    products = {"evap": (daily, "value"), "pet": (daily, "orders")}
    h = HM.harmonise_to_reference(ref, products, drought=True, decimals=TIES)
    return h.select("lat", "lon", "time", "ndvi", *r6("lst_mean"), fixed6("evap"), fixed6("pet"), "drought_spei", "drought_spi", "drought_ndvi")


@register("harmonise_evaporation")
def q_harmonise_evaporation(spark, sf_dir):
    ref = load_grid(spark, sf_dir).select("lat", "lon", "time", "sm")
    h = HM.evaporation_cleaner(ref, load_daily_product(spark, sf_dir), path=IO.scratch_path(spark, "evaporation"))
    # value / 28 of 5-decimal data can land exactly on a rounding tie
    return h.select("lat", "lon", "time", fixed6("evaporation"))


@register("harmonise_rainfall")
def q_harmonise_rainfall(spark, sf_dir):
    ref = load_grid(spark, sf_dir).select("lat", "lon", "time", "sm")
    h = HM.rainfall_cleaner(ref, load_daily_product(spark, sf_dir), path=IO.scratch_path(spark, "rainfall"))
    return h.select("lat", "lon", "time", *r6("precip"))


@register("reference_cleaner")
def q_reference_cleaner(spark, sf_dir):
    """C5 on the daily product, moved to the west edge of the fixed region."""
    p = load_daily_product(spark, sf_dir).withColumn("longitude", F.col("longitude") + 30.0)
    h = HM.reference_cleaner(p, path=IO.scratch_path(spark, "reference"))
    return h.select("lat", "lon", "time", fixed6("holaps_evapotranspiration"))


def _projected(spark, sf_dir, x0, y0, step):
    """The daily product's columns and rows as pixels of a projected map, ``step`` metres wide."""
    at = lambda c, first: F.round(F.col(c) / 0.2) * F.lit(step) + F.lit(first)
    return load_daily_product(spark, sf_dir).select(at("longitude", x0).alias("x"), at("latitude", y0).alias("y"), "time", "value")


@register("reference_cleaner_sinusoidal")
def q_reference_cleaner_sinusoidal(spark, sf_dir):
    """C5 from the sinusoidal map on: reprojection by area, box, units, first value per month."""
    p = _projected(spark, sf_dir, 3_611_000.0, -187_000.0, 23_000.0)
    h = HM.reference_cleaner(p, path=IO.scratch_path(spark, "sinusoidal"), projection=sinusoidal(23_000.0, 23_000.0), sum_decimals=5)
    return h.select("lat", "lon", "time", fixed6("holaps_evapotranspiration"))


@register("reproject_geostationary")
def q_reproject_geostationary(spark, sf_dir):
    """The reprojection alone, of pixels that reach beyond the disc (those have no place)."""
    p = _projected(spark, sf_dir, 2_010_000.0, 4_503_000.0, 151_000.0)
    r = reproject(p, geostationary(151_000.0, 151_000.0, lon_0=9.5), 1.5, ["value"], sum_decimals=5)
    return r.select(*r6("lat", "lon"), "time", fixed6("value"))


# ------------------------------------------------------- small report queries


@register("pixel_year_counts")
def q_pixel_year_counts(spark, sf_dir):
    """A5/A23 on the cleaned rows: processed and skipped pixel-years."""
    c = clean_cube(load_grid(spark, sf_dir), PARAMS)
    return count_pixel_years(c)


@register("min_max")
def q_min_max(spark, sf_dir):
    return S.min_max(_masked_grid(spark, sf_dir), GRID_VARS)


@register("lst_mask_by_mean")
def q_lst_mask_by_mean(spark, sf_dir):
    """P26 then P6: every LST variable kept only where lst_mean < 100."""
    from terracube.operators.clean import mask_by_other
    from terracube.operators.units import mean_of
    g = mean_of(load_grid(spark, sf_dir), "lst_mean", "lst_day", "lst_night")
    g = mask_by_other(g, "lst_mean", 100.0, ["lst_day", "lst_night"])
    return g.select("lat", "lon", "time", "lst_day", "lst_night")


@register("labelled_stack")
def q_labelled_stack(spark, sf_dir):
    """Predictions and truth stacked with a label column."""
    from terracube.plans.verify import persistence_forecast, truth
    g = load_grid(spark, sf_dir)
    p = persistence_forecast(g).withColumnRenamed("prediction", "ndvi")
    t = truth(g).withColumnRenamed("y", "ndvi")
    return S.stack_labelled({"prediction": p, "truth": t})


@register("first_rows")
def q_first_rows(spark, sf_dir):
    """First 10 cube rows in key order."""
    return S.head_rows(load_grid(spark, sf_dir), 10, ["time", "lat", "lon"])


@register("month_names")
def q_month_names(spark, sf_dir):
    """F12 with A7: month name next to the seasonal maximum."""
    from terracube.functions.time import month_name
    g = load_grid(spark, sf_dir)
    names = g.select(F.month("time").alias("month"), month_name("time").alias("month_name")).distinct()
    return S.seasonal_max(g, "ndvi").join(names, "month").select("month", "month_name", *r6("ndvi_max_monthly_mean"))


@register("smooth_l1")
def q_smooth_l1(spark, sf_dir):
    """Smooth-L1 loss of the persistence forecast per calendar year."""
    from terracube.operators.metrics import smooth_l1
    v = verification_frame(load_grid(spark, sf_dir))
    return v.groupBy(F.year("time").alias("year")).agg(F.count(F.lit(1)).alias("n"), smooth_l1(sum_decimals=7)).select(
        "year", "n", fixed6("smooth_l1"))


# ------------------------------------------------------- sinks and round trips
# Rows-only: each writes to the shared checkpoint folder and reads back.


@register("round_trip_csv")
def q_round_trip_csv(spark, sf_dir):
    """S3 -> S2 on the cleaned rows (explicit schema on read)."""
    c = IO.public(clean_cube(load_grid(spark, sf_dir), PARAMS))
    path = IO.scratch_path(spark, "clean-csv")
    IO.write_csv(c, path)
    schema = T.StructType([T.StructField(n, T.TimestampNTZType() if n == "time" else
                                         T.IntegerType() if n in ("gb_year", "gb_month") else T.DoubleType())
                           for n in c.columns])
    back = IO.read_csv(spark, path, schema)
    return back.select(*[c for c in back.columns if c != "ndvi_anomaly"], *r6("ndvi_anomaly"))


@register("round_trip_json")
def q_round_trip_json(spark, sf_dir):
    """Normalising statistics written as JSON and read back."""
    st = normalising_stats(clean_cube(load_grid(spark, sf_dir), PARAMS), VALUE_COLS)
    path = IO.scratch_path(spark, "stats-json")
    IO.write_stats(st, path)
    return IO.read_stats(spark, path).select("variable", *r6("mean", "std"))


@register("guarded_write")
def q_guarded_write(spark, sf_dir):
    """The second unforced write is ignored; the forced one replaces."""
    g = load_grid(spark, sf_dir)
    path, forced = IO.scratch_path(spark, "guarded"), IO.scratch_path(spark, "guarded-forced")
    later = g.withColumn("ndvi", F.col("ndvi") + 1)
    for p in (path, forced):
        LY.guarded_write(g, p)
    LY.guarded_write(later, path)  # ignored
    LY.guarded_write(later, forced, force=True)  # replaces
    return S.stack_labelled({"kept": LY.read_guarded(spark, path), "forced": LY.read_guarded(spark, forced)}, "write").select(
        "lat", "lon", "time", "precip", *r6("ndvi"), "write")


@register("cube_blocks_box")
def q_cube_blocks_box(spark, sf_dir):
    """S7/S1 by space and time: a box of the cube from the files that it meets."""
    path = IO.scratch_path(spark, "blocks")
    LY.write_cube_blocks(load_grid(spark, sf_dir), path, files=16)
    return LY.read_cube_blocks(spark, path, lat=(0.25, 0.75), lon=(1.0, 3.0), time=("1998-03-01", "1999-06-01"))


@register("tiles_round_trip")
def q_tiles_round_trip(spark, sf_dir):
    """One variable as dense tiles, and back."""
    g = load_grid(spark, sf_dir)
    return TL.from_tiles(TL.to_tiles(g, "sm"), TL.axes(g), "sm")


@register("tile_slice")
def q_tile_slice(spark, sf_dir):
    """A box of positions cut from the tiles."""
    g = load_grid(spark, sf_dir)
    on = TL.axes(g)
    return TL.from_tiles(TL.cut_tiles(TL.to_tiles(g, "precip", (2, 4, 12), on), (1, 4), (2, 9), (10, 30)), on, "precip")


@register("nan_ingest")
def q_nan_ingest(spark, sf_dir):
    """NaN in a stored cube (Parquet and CSV) is missing after the read."""
    g = load_grid(spark, sf_dir).select("lat", "lon", "time", F.coalesce("sm", F.lit(float("nan"))).alias("sm"))
    a, b = IO.scratch_path(spark, "nan"), IO.scratch_path(spark, "nan-csv")
    IO.write_cube(g, a)
    IO.write_csv(g, b)
    frames = {"parquet": IO.read_cube(spark, a).drop("year"), "csv": IO.read_csv(spark, b, IO.cube_schema(["sm"], T.TimestampNTZType()))}
    return S.stack_labelled({n: S.time_mean(f, ["sm"], sum_decimals=6) for n, f in frames.items()}, "format")


@register("parse_time")
def q_parse_time(spark, sf_dir):
    """times written as text, parsed back."""
    g = load_grid(spark, sf_dir)
    iso, named = F.date_format("time", "yyyy-MM-dd HH:mm:ss"), F.date_format("time", "dd/MM/yyyy")
    return g.select("lat", "lon", parse_time(iso).alias("time"), parse_time(named, "dd/MM/yyyy").alias("time_named"))


@register("cube_round_trip")
def q_cube_round_trip(spark, sf_dir):
    """S7 -> S1: the cube partitioned by year and read back, all values."""
    path = IO.scratch_path(spark, "cube")
    IO.write_cube(load_grid(spark, sf_dir), path)
    return IO.read_cube(spark, path).select(*KEY_COLS[:3], *GRID_VARS)


@register("model_round_trip")
def q_model_round_trip(spark, sf_dir):
    """Predictions and model written and read back; the loaded model scores alike."""
    ex, _ = _examples(spark, sf_dir)
    preds, model, _ = ML.linear_fit_score(ex)
    path, model_path = IO.scratch_path(spark, "preds"), IO.scratch_path(spark, "model")
    IO.write_predictions(preds, path)
    IO.save_model(model, model_path)
    data, _ = ML.prepare(ex)
    again = ML.score(IO.load_linear_model(model_path), data).withColumnRenamed("prediction", "again")
    keys = ["lat", "lon", "gb_year", "split"]
    j = IO.read_predictions(spark, path).join(again.drop("y"), keys)
    return j.select(*keys, "y", (F.round(F.col("prediction") - F.col("again"), 6) + 0.0).alias("difference"))


@register("examples_round_trip")
def q_examples_round_trip(spark, sf_dir):
    """Examples by split, the test split read back with pruning."""
    ex, _ = _examples(spark, sf_dir)
    path = IO.scratch_path(spark, "examples")
    IO.write_examples(ex, path)
    test = IO.read_examples(spark, path, "test")
    flat = test.select("lat", "lon", "gb_year", "split", "y", F.posexplode(F.flatten("x")).alias("j", "v"))
    return flat.select("lat", "lon", "gb_year", "split", "y", "j", *r6("v"))


@register("stream_monthly_first")
def q_stream_monthly_first(spark, sf_dir):
    """A4 as Structured Streaming over the daily product written as files."""
    from terracube.sources.grid import load_daily_product
    from terracube.streaming import run_monthly_first
    daily = normalise_coordinate_names(load_daily_product(spark, sf_dir))
    src = IO.scratch_path(spark, "daily")
    daily.write.mode("overwrite").parquet(src)
    out, ck = IO.scratch_path(spark, "monthly"), IO.scratch_path(spark, "monthly-ckpt")
    run_monthly_first(spark, src, daily.schema, ["lat", "lon"], "value", out, ck)
    return spark.read.parquet(out).select("lat", "lon", F.col("month").cast("timestamp_ntz").alias("time"),
                                          "value", "n_obs")
