"""Guards and small helpers: exact time slice, frequency
inference on irregular series, matrix view (S12), time parsing (F2)."""

import datetime as dt

import pytest

from terracube.functions.time import month_name, parse_time
from terracube.operators.resample import infer_freq
from terracube.operators.slicing import time_slice_exact
from terracube.sources.io import to_matrix


def _months(spark, months, year=2000):
    return spark.createDataFrame([(dt.datetime(year, m, 1),) for m in months], "time timestamp")


def test_time_slice_exact_checks_steps(spark):
    ref = _months(spark, [2, 3, 4])
    assert time_slice_exact(ref, _months(spark, [1, 2, 3, 4, 5])).count() == 3
    with pytest.raises(Exception, match="time steps differ"):
        time_slice_exact(ref, _months(spark, [2, 4])).count()


def test_infer_freq_classes(spark):
    ms = infer_freq(_months(spark, [1, 2, 3])).collect()[0]
    assert ms.freq == "MS"
    irregular = infer_freq(_months(spark, [1, 2, 5])).collect()[0]
    assert irregular.freq is None
    days = spark.createDataFrame([(dt.datetime(2000, 1, d),) for d in (1, 2, 3)], "time timestamp")
    assert infer_freq(days).collect()[0].freq == "D"


def test_matrix_view(spark):
    t = dt.datetime(2000, 1, 1)
    df = spark.createDataFrame([(0.0, 0.0, t, 1.0), (0.0, 1.0, t, 2.0), (1.0, 0.0, t, 3.0)],
                               "lat double, lon double, time timestamp, v double")
    m = {r.lat: (r.lon, r.v) for r in to_matrix(df, "v", t).collect()}
    assert m == {0.0: ([0.0, 1.0], [1.0, 2.0]), 1.0: ([0.0], [3.0])}


def test_parse_time_and_month_name(spark):
    df = spark.createDataFrame([("2001-06-15 00:00:00",)], "s string")
    r = df.select(parse_time("s").alias("t")).select("t", month_name("t").alias("m")).collect()[0]
    assert r.t == dt.datetime(2001, 6, 15) and r.m == "June"
