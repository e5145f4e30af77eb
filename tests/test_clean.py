"""Clean pipeline operators: W7, P5, W1, P7, A1, P4 (FIXTURES §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terracube.functions.time import relative_month_year, with_relative_time
from terracube.operators.clean import (anomaly, drop_incomplete, mask_sentinel,
                                       normalising_stats, zscore)


def _ts(y, m, d=1):
    return dt.datetime(y, m, d)


def test_relative_year_groups(spark):
    # 24 month starts 2018-01..2019-12; groups 1x5, 2x12, 3x7; pred_month 5
    times = [_ts(2018 + (i // 12), i % 12 + 1) for i in range(24)]
    groups = [1] * 5 + [2] * 12 + [3] * 7
    df = spark.createDataFrame(list(zip(times, groups)), "time timestamp, group int")
    out = with_relative_time(df, 5).collect()
    in_2019 = [r.group for r in out if r.gb_year == 2019]
    assert in_2019 == [2] * 12
    by_time = {r.time: (r.gb_month, r.gb_year) for r in out}
    assert by_time[_ts(2018, 5)] == (12, 2018)
    assert by_time[_ts(2018, 6)] == (1, 2019)


def test_relative_year_december_and_month_end(spark):
    df = spark.createDataFrame([(_ts(2018, 7, 31),), (_ts(2017, 3, 15),)], "time timestamp")
    m12, y12 = relative_month_year("time", 12)
    m5, y5 = relative_month_year("time", 5)
    rows = df.select(m12.alias("m12"), y12.alias("y12"), m5.alias("m5"), y5.alias("y5")).collect()
    assert (rows[0].m12, rows[0].y12) == (7, 2018)
    assert (rows[1].m12, rows[1].y12) == (3, 2017)
    # 2018-07-31 - 5 months = 2018-02-28 -> month 2, year 2019
    assert (rows[0].m5, rows[0].y5) == (2, 2019)


def test_sentinel_mask(spark):
    df = spark.createDataFrame([(199.9,), (200.0,), (250.0,), (None,)], "lst_day double")
    assert [r.lst_day for r in mask_sentinel(df).collect()] == [199.9, None, None, None]


def _pixel(spark, rows):
    return spark.createDataFrame(
        [(0.0, 0.0, _ts(y, 1), v, p) for y, v, p in rows],
        "lat double, lon double, time timestamp, ndvi double, precip double")


def test_anomaly_climatology(spark):
    df = _pixel(spark, [(2014, 1.0, 1.0), (2015, 3.0, 1.0), (2016, 10.0, 1.0)])
    out = anomaly(df, "ndvi", clim_before_year=2016).orderBy("time").collect()
    assert [r.ndvi_anomaly for r in out] == [-1.0, 1.0, 8.0]


def test_anomaly_before_drop(spark):
    # the 2014 row is dropped later but still counts in the climatology
    df = _pixel(spark, [(2014, 1.0, None), (2015, 3.0, 1.0), (2016, 10.0, 1.0)])
    out = drop_incomplete(anomaly(df, "ndvi", clim_before_year=2016)).orderBy("time").collect()
    assert [r.ndvi_anomaly for r in out] == [1.0, 8.0]


def test_zscore_sample_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    st = normalising_stats(df, ["v"]).collect()[0]
    assert st.mean == pytest.approx(2.333333, abs=1e-6)
    assert st.std == pytest.approx(1.527525, abs=1e-6)
    z = [r.v for r in zscore(df, ["v"]).collect()]
    assert sum(z) == pytest.approx(0.0, abs=1e-12)


def test_zscore_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert [r.v for r in zscore(df, ["v"]).collect()] == [None, None]


def test_clean_invariants(spark):
    from terracube.queries import PARAMS
    from terracube.plans.clean import clean_and_scale, clean_cube
    from terracube.schema import VALUE_COLS
    from terracube.sources.grid import load_grid
    g = load_grid(spark, "/root/testdata/sf0.001")
    c = clean_cube(g, PARAMS)
    assert c.where(F.greatest(*[F.col(v).isNull() for v in VALUE_COLS])).count() == 0
    scaled, _ = clean_and_scale(g, PARAMS)
    r = scaled.agg(*[F.avg(v).alias(f"m_{v}") for v in VALUE_COLS],
                   *[F.stddev_samp(v).alias(f"s_{v}") for v in VALUE_COLS]).collect()[0]
    for v in VALUE_COLS:
        assert r[f"m_{v}"] == pytest.approx(0.0, abs=1e-9)
        assert r[f"s_{v}"] == pytest.approx(1.0, abs=1e-9)
    # target stays in raw units
    raw = {(x.lat, x.lon, x.time): x.ndvi for x in c.select("lat", "lon", "time", "ndvi").collect()}
    assert {(x.lat, x.lon, x.time): x.target for x in scaled.select("lat", "lon", "time", "target").collect()} == raw
