"""Gaps, NaN, NULL pairs, ties, repeated keys and off-calendar rows."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracube.functions.quantile import exact_quantiles
from terracube.operators import masks as MK
from terracube.operators import metrics as MT
from terracube.operators import slicing as SL
from terracube.operators import stats as S
from terracube.operators.lookup import bands_to_time
from terracube.operators.merge import align_predictions, merge_cubes
from terracube.operators.regrid import regrid_bilinear
from terracube.operators.resample import densify, resample_median
from terracube.plans import models as ML
from terracube.sources import io as IO

CUBE = "lat double, lon double, time timestamp_ntz, v double"


def m(i, day=1):
    return dt.datetime(2000, i, day)


def test_nan_is_missing_after_the_read(spark):
    df = spark.createDataFrame([(0.0, 0.0, m(1), float("nan")), (0.0, 0.0, m(2), 2.0), (0.0, 0.0, m(3), None)], CUBE)
    path, csv = IO.scratch_path(spark, "t-nan"), IO.scratch_path(spark, "t-nan-csv")
    IO.write_cube(df, path)
    IO.write_csv(df, csv)
    for back in (IO.read_cube(spark, path), IO.read_csv(spark, csv, df.schema)):
        assert back.agg(F.avg("v")).first()[0] == 2.0


def test_bands_and_times_must_match(spark):
    wide = spark.createDataFrame([(1, 10.0, 20.0, 30.0)], "k int, Band1 double, Band2 double, Band3 double")
    for n in (2, 4):
        times = spark.createDataFrame([(i, m(i)) for i in range(1, n + 1)], "idx int, time timestamp_ntz")
        with pytest.raises(Exception, match="band count"):
            bands_to_time(wide, times, ["k"], "v").select("v").collect()
    times = spark.createDataFrame([(i, m(i)) for i in (1, 2, 3)], "idx int, time timestamp_ntz")
    assert {r.time.month: r.v for r in bands_to_time(wide, times, ["k"], "v").collect()} == {1: 10.0, 2: 20.0, 3: 30.0}


def test_metrics_use_complete_pairs_only(spark):
    pairs = [(1.0, 1.5), (2.0, 2.5), (3.0, None), (None, 7.0)]
    df = spark.createDataFrame(pairs, "y double, prediction double")
    for decimals in (None, 6):
        r = MT.verify(df, sum_decimals=decimals).first()
        assert (r.n, r.mae, r.rmse) == (2, 0.5, 0.5)
        assert r.explained_variance == pytest.approx(1.0) and r.r2 == pytest.approx(1 - 0.5 / 0.5)
        assert r.pct_bias == pytest.approx(100 * 0.5 / 1.5)


def test_drought_threshold_is_not_rounded(spark):
    values = [5e-10] * 5 + [1e-10]
    df = spark.createDataFrame([(0.0, 0.0, dt.datetime(2000 + i, 1, 1), v) for i, v in enumerate(values)], CUBE)
    for f in (MK.monthly_drought, MK.series_drought):
        assert [r.d for r in f(df, "v", "d").orderBy("time").collect()] == [False] * 5 + [True]


def test_densify_keeps_every_observation(spark):
    df = spark.createDataFrame([(0.0, 0.0, m(1), 1.0), (0.0, 0.0, m(3), 3.0), (0.0, 0.0, m(1, 15), 9.0), (1.0, 0.0, m(2), 2.0)], CUBE)
    got = {(r.lat, r.time): r.v for r in densify(df).collect()}
    assert got == {(0.0, m(1)): 1.0, (0.0, m(2)): None, (0.0, m(3)): 3.0, (0.0, m(1, 15)): 9.0, (1.0, m(1)): None, (1.0, m(2)): 2.0, (1.0, m(3)): None}


def test_repeated_keys_raise(spark):
    twice = spark.createDataFrame([(0.0, 0.0, m(1), 1.0), (0.0, 0.0, m(1), 2.0)], CUBE)
    other = twice.limit(1).withColumnRenamed("v", "w")
    for df in (densify(twice), merge_cubes(twice, other), merge_cubes(other, twice)):
        with pytest.raises(Exception, match="occurs twice"):
            df.collect()
    p = twice.withColumn("__pix", F.lit(1).cast("long"))
    with pytest.raises(Exception, match="occurs twice"):
        align_predictions(p.withColumnRenamed("v", "prediction"), p.withColumnRenamed("v", "y").limit(1), ["lat", "lon", "time"]).collect()


def test_histogram_has_all_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (4.0,), (None,)], "v double")
    assert [(r.bucket, r["count"], r.edge_lo) for r in S.histogram(df, "v", 4).orderBy("bucket").collect()] == [(1, 2, 0.0), (2, 0, 1.0), (3, 0, 2.0), (4, 1, 3.0)]
    assert [(r.bucket, r["count"]) for r in S.histogram(df.where("v = 4"), "v", 4).collect()] == [(1, 1)]
    assert S.histogram(df.limit(0), "v", 4).count() == 0


def test_bilinear_covers_the_target_grid(spark):
    cube = spark.createDataFrame([(a, b, m(1), a + b) for a in (0.0, 1.0) for b in (0.0, 1.0)] + [(0.0, 0.0, m(2), 5.0)], CUBE)
    axis = lambda *v: spark.createDataFrame([(x,) for x in v], "v double")
    got = {(r.lat, r.lon, r.time.month): r.v for r in regrid_bilinear(cube, axis(0.5, 3.0), axis(0.5, -1.0), ["v"]).collect()}
    assert len(got) == 8 and got.pop((0.5, 0.5, 1)) == pytest.approx(1.0)
    assert set(got.values()) == {None}


def test_positions_on_any_axis(spark):
    cube = spark.createDataFrame([(a, 0.0, m(1, d), float(d)) for a in (2.0, 1.0) for d in (3, 1, 2)], CUBE)
    assert {r.time.day for r in SL.isel(cube, "time", 1).collect()} == {2}
    assert {r.time.day for r in SL.isel(cube, "time", -1).collect()} == {3}
    assert {r.lat for r in SL.isel(cube, "lat", 0).collect()} == {1.0}
    assert SL.isel(cube, "time", 3).count() == SL.isel(cube, "lat", -3).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 999, 1001, 250_000])
def test_quantiles_are_exact_at_every_size(spark, n):
    qs = [0.0, 0.025, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.pow((F.xxhash64("id") % 10_007) / 10_007.0, F.lit(3))).alias("v"),
                               (F.col("id") % 2).alias("k")).repartition(7)
    for keys, few in (((), False), (("k",), False), (("k",), True)):
        rows = df.toPandas()
        for r in exact_quantiles(df, "v", qs, keys, few_groups=few).collect():
            v = rows if not keys else rows[rows["k"] == r["k"]]
            assert math.isclose(r["quantile"], float(np.quantile(v["v"], r["q"])), rel_tol=1e-12, abs_tol=1e-15), (n, keys, r)


def test_median_is_one_scan_without_join(spark):
    df = spark.createDataFrame([(1, m(1, d), float(d % 4)) for d in range(1, 29)] + [(2, m(1), None)], "k int, time timestamp_ntz, v double")
    out = resample_median(df, ["k"], "v")
    assert [(r.k, r.v) for r in out.collect()] == [(1, 1.5)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_background_sample_has_exactly_k_rows(spark):
    df = spark.range(30).select((F.col("id") * 1.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(2000).alias("gb_year"))
    a = [r.lat for r in ML.background_sample(df.repartition(3), k=50).collect()]
    b = [r.lat for r in ML.background_sample(df.repartition(8), k=50).collect()]
    assert sorted(a) == sorted(b) and len(a) == 50 and 15 <= len(set(a)) < 30
    assert ML.background_sample(df.limit(0), k=5).count() == 0


def test_weights_round_trip(spark):
    path = IO.scratch_path(spark, "t-weights")
    for w in (ML.init_ffn(4), ML.init_rnn(3, hidden=5, dense=(4,))):
        ML.save_weights(spark, w, path)
        back = ML.load_weights(spark, path)
        assert set(back) == set(w) and all(np.array_equal(back[k], w[k]) for k in w)


def test_checkpoint_folder_must_be_shared():
    from types import SimpleNamespace

    from terracube.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d)))
