"""Window operators: W2, W5, W6, W8, P33 (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from terracube.operators.windows import (example_arrays, example_steps, flip_lat,
                                         lag_stack, shift_time, split_by_year)


def _m(month, year=2000):
    return dt.datetime(year, month, 1)


def test_lag_stack_dense(spark):
    rows = [(0.0, 0.0, _m(i + 1), float(10 * (i + 1)), i == 4) for i in range(5)]
    df = spark.createDataFrame(rows, "lat double, lon double, time timestamp, v double, mask boolean")
    out = lag_stack(df, ["v"], 3).where("mask").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.v_t0, r.v_t1, r.v_t2, r.v_t3) == (50.0, 40.0, 30.0, 20.0)


def test_lag_stack_gap_gives_null(spark):
    rows = [(0.0, 0.0, _m(1), 1.0), (0.0, 0.0, _m(2), 2.0), (0.0, 0.0, _m(4), 4.0)]
    df = spark.createDataFrame(rows, "lat double, lon double, time timestamp, v double")
    april = lag_stack(df, ["v"], 1).where(F.month("time") == 4).collect()[0]
    assert april.v_t1 is None
    shifted = {r.time.month: r.v for r in shift_time(df, ["v"], 1).collect()}
    assert shifted == {1: None, 2: 1.0, 4: None}  # a row lag would give 2.0 in April
    assert {r.time.month: r.v for r in shift_time(df, ["v"], -1).collect()} == {1: 2.0, 2: None, 4: None}


def test_flip_lat(spark):
    rows = [(0.0, 5.0, _m(1), "a"), (1.0, 5.0, _m(1), "b"), (2.0, 5.0, _m(1), "c")]
    df = spark.createDataFrame(rows, "lat double, lon double, time timestamp, v string")
    out = {r.lat: r.v for r in flip_lat(df, ["v"]).collect()}
    assert out == {0.0: "c", 1.0: "b", 2.0: "a"}


def test_flip_lat_keeps_other_columns(spark):
    rows = [(0.0, 5.0, _m(1), 1.0, 10.0), (1.0, 5.0, _m(1), 2.0, 20.0)]
    df = spark.createDataFrame(rows, "lat double, lon double, time timestamp, p double, q double")
    out = {r.lat: (r.p, r.q) for r in flip_lat(df, ["p"]).collect()}
    assert out == {0.0: (2.0, 10.0), 1.0: (1.0, 20.0)}


def test_example_assembly(spark):
    full = [(0.0, 0.0, 2001, m, _m(m), float(m), float(m)) for m in range(1, 13)]
    short = [(1.0, 0.0, 2001, m, _m(m), float(m), float(m)) for m in range(1, 12)]
    df = spark.createDataFrame(full + short,
                               "lat double, lon double, gb_year int, gb_month int, time timestamp, "
                               "v double, target double")
    steps = example_steps(df, ["v"])
    ex = example_arrays(steps, ["v"]).collect()
    assert len(ex) == 1
    assert [x[0] for x in ex[0].x] == [float(i) for i in range(1, 12)]
    assert ex[0].y == 12.0


def test_split_by_year(spark):
    df = spark.createDataFrame([(2015,), (2016,), (2017,)], "gb_year int")
    out = {r.gb_year: r.split for r in split_by_year(df, 2016).collect()}
    assert out == {2015: "train", 2016: "test"}


def test_examples_invariants(spark):
    from terracube.queries import _examples
    ex, _ = _examples(spark, "/root/testdata/sf0.001")
    rows = ex.select(F.size("x").alias("n"), F.size(F.col("x")[0]).alias("f"), "split", "gb_year").collect()
    assert rows and all(r.n == 11 and r.f == 7 for r in rows)
    assert all(r.gb_year < 2001 for r in rows if r.split == "train")
    assert all(r.gb_year == 2001 for r in rows if r.split == "test")
