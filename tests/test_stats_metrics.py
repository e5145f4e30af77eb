"""Aggregations and metrics: A1, A4, A8, A13, A14, A15-A19, P23, P30, P31."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terracube.functions.quantile import exact_quantiles, ordered_bits
from terracube.operators.masks import series_drought, threshold_flag
from terracube.operators.metrics import verify
from terracube.operators.resample import resample_first
from terracube.operators.stats import histogram


def test_series_drought(spark):
    df = spark.createDataFrame([(0.0, 0.0, float(v)) for v in range(1, 6)], "lat double, lon double, ndvi double")
    out = {r.ndvi: r.drought_ndvi for r in series_drought(df).collect()}
    assert out == {1.0: True, 2.0: False, 3.0: False, 4.0: False, 5.0: False}


def test_threshold_flag(spark):
    df = spark.createDataFrame([(-1.5,), (-1.0,), (0.0,), (None,)], "spi double")
    assert [r.f for r in df.select(threshold_flag("spi").alias("f")).collect()] == [True, False, False, False]


def test_resample_first_skips_null(spark):
    rows = [(1, dt.datetime(2020, 1, d), v) for d, v in [(1, None), (2, 5.0), (3, 6.0)]]
    df = spark.createDataFrame(rows, "k int, time timestamp, value double")
    out = resample_first(df, ["k"], "value").collect()
    assert out[0].value == 5.0 and out[0].time == dt.date(2020, 1, 31)


def test_exact_quantiles_small(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 6)], "v double")
    got = {r.q: r.quantile for r in exact_quantiles(df, "v", [0.2, 0.95]).collect()}
    assert got[0.2] == pytest.approx(1.8) and got[0.95] == pytest.approx(4.8)


def test_exact_quantiles_ties_and_groups(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=4000), np.zeros(3000)])
    g = rng.integers(0, 3, size=vals.size)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, vals)], "g int, v double")
    qs = [0.01, 0.33, 0.5, 0.9]
    got = {(r.g, r.q): r.quantile for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for k in range(3):
        for q in qs:
            assert got[(k, q)] == pytest.approx(np.quantile(vals[g == k], q), abs=1e-12)


@pytest.mark.parametrize("draw", [lambda r, n: r.pareto(1.05, n), lambda r, n: np.exp(3 * r.standard_normal(n)), lambda r, n: -np.exp(40 * r.standard_normal(n))])
def test_quantiles_of_heavy_tails(spark, draw):
    x = draw(np.random.default_rng(3), 60_000)
    df = spark.createDataFrame(pd.DataFrame({"v": x})).repartition(6)
    qs = [0.001, 0.5, 0.999, 0.9999, 1.0]
    got = {r.q: r.quantile for r in exact_quantiles(df, "v", qs).collect()}
    assert got == {q: pytest.approx(float(np.quantile(x, q)), rel=1e-13) for q in qs}


def test_quantile_rounds_hash(spark):
    """An array in an aggregate's buffer makes Spark sort all rows of a round."""
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in range(5)], "k string, v double")
    q = exact_quantiles(df, "v", [0.25, 0.5], ["k"], few_groups=True)
    assert "SortAggregate" not in q._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, q.collect())) == [("a", 0.25, 1.0), ("a", 0.5, 2.0), ("b", 0.25, 1.0), ("b", 0.5, 2.0)]


def test_ordered_bits_are_the_ieee_bits(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal(300), rng.standard_cauchy(300) * 1e300, [0.0, 5e-324, -5e-324, 2.0**-1022, np.nextafter(2.0**-1022, 0), np.finfo(float).max, -np.finfo(float).max, np.inf, -np.inf],
                        2.0 ** rng.integers(-1074, 1023, 300).astype(float), np.nextafter(2.0 ** rng.integers(-1000, 1000, 300).astype(float), 0)])
    got = spark.createDataFrame(pd.DataFrame({"x": x})).select("x", ordered_bits(F.col("x")).alias("b")).toPandas()
    bits = np.abs(got["x"].to_numpy()).view(np.int64)
    assert (got["b"].to_numpy() == np.where(got["x"] >= 0, bits, -bits - 1)).all()
    row = spark.sql("SELECT double('-0.0') AS a, double('NaN') AS b, double(NULL) AS c").select(*[ordered_bits(F.col(c)) for c in "abc"]).first()
    assert row[0] == 0 and row[1] > got["b"].max() and row[2] is None


def test_histogram_last_edge_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4]], "v double")
    out = {r.bucket: r["count"] for r in histogram(df, "v", 4).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 2}


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.8), (3.0, 3.3)], "y double, prediction double")
    r = verify(df).collect()[0]
    assert r.rmse == pytest.approx(0.216025, abs=1e-6)
    assert r.mae == pytest.approx(0.2, abs=1e-9)
    assert r.r2 == pytest.approx(0.93, abs=1e-9)
    assert r.explained_variance == pytest.approx(0.936667, abs=1e-6)
    assert r.pct_bias == pytest.approx(3.333333, abs=1e-6)


def test_densify_fills_calendar(spark):
    from terracube.operators.resample import densify
    rows = [(0.0, 0.0, dt.datetime(2000, 1, 1), 1.0), (0.0, 0.0, dt.datetime(2000, 3, 1), 3.0),
            (1.0, 0.0, dt.datetime(2000, 2, 1), None)]
    df = spark.createDataFrame(rows, "lat double, lon double, time timestamp, v double")
    out = {(r.lat, r.time.month): r.v for r in densify(df).collect()}
    assert out == {(0.0, 1): 1.0, (0.0, 2): None, (0.0, 3): 3.0,
                   (1.0, 1): None, (1.0, 2): None, (1.0, 3): None}
