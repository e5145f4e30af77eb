"""Sinks/sources (S2-S10), conformity checks (P1, P35), relabel (A22) and
the streaming monthly resample against its batch form."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terracube.operators.conform import check_same_grid, normalise_coordinate_names
from terracube.operators.resample import relabel_by_position, resample_first
from terracube.sources import io as IO
from terracube.sources import layout as LY
from terracube.sources.grid import load_daily_product, load_grid

SF = "/root/testdata/sf0.001"


def test_examples_split_pruning(spark):
    from terracube.queries import _examples
    ex, _ = _examples(spark, SF)
    path = IO.scratch_path(spark, "t-examples")
    IO.write_examples(ex, path)
    test = IO.read_examples(spark, path, "test")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
    assert test.count() == ex.where("split = 'test'").count()
    with pytest.raises(ValueError):
        IO.read_examples(spark, path, "validation")


def test_stats_json_round_trip(spark):
    st = spark.createDataFrame([("ndvi", 0.5, 0.1)], "variable string, mean double, std double")
    path = IO.scratch_path(spark, "t-stats")
    IO.write_stats(st, path)
    assert IO.read_stats(spark, path).collect() == st.collect()


def test_guarded_write(spark):
    a = spark.createDataFrame([(1.0,)], "v double")
    b = spark.createDataFrame([(2.0,)], "v double")
    path = IO.scratch_path(spark, "t-guard")
    assert LY.guarded_write(a, path) and not LY.guarded_write(b, path)
    assert [r.v for r in LY.read_guarded(spark, path).collect()] == [1.0]
    assert LY.guarded_write(b, path, force=True)
    assert [r.v for r in LY.read_guarded(spark, path).collect()] == [2.0]
    assert LY.manifest(spark, path)["rows"] == 1


def test_what_a_failed_write_leaves_does_not_count(spark):
    path = IO.scratch_path(spark, "t-half")
    good = spark.createDataFrame([(1.0,)], "v double")
    bad = good.select(F.raise_error(F.lit("lost")).cast("double").alias("v")).unionByName(good)
    with pytest.raises(Exception, match="lost"):
        LY.guarded_write(bad, path)
    good.write.parquet(f"{path}/version-half")  # a whole folder that was never published
    assert LY.manifest(spark, path) is None
    with pytest.raises(FileNotFoundError):
        LY.read_guarded(spark, path)
    assert LY.guarded_write(good, path)
    assert LY.read_guarded(spark, path).count() == 1
    with pytest.raises(Exception, match="lost"):
        LY.guarded_write(bad, path, force=True)
    assert LY.read_guarded(spark, path).count() == 1  # the former data stay


def test_csv_round_trip_schema(spark):
    df = spark.createDataFrame([(0.25, 1.5, dt.datetime(2000, 1, 1), 3.0)],
                               "lat double, lon double, time timestamp, v double")
    path = IO.scratch_path(spark, "t-csv")
    IO.write_csv(df, path)
    back = IO.read_csv(spark, path, IO.cube_schema(["v"]))
    assert back.collect() == df.collect()


def test_cube_partitioned_by_year(spark):
    g = load_grid(spark, SF)
    path = IO.scratch_path(spark, "t-cube")
    IO.write_cube(g, path)
    back = IO.read_cube(spark, path).where("year = 1999")
    assert back.count() == g.where("year(time) = 1999").count()


def test_coordinate_names_and_grid_check(spark):
    d = normalise_coordinate_names(load_daily_product(spark, SF))
    assert {"lat", "lon", "time"} <= set(d.columns)
    with pytest.raises(ValueError):
        normalise_coordinate_names(spark.createDataFrame([(1.0,)], "latitude double"))
    g = load_grid(spark, SF)
    assert check_same_grid(g, g).count() == g.count()
    with pytest.raises(Exception, match="grids differ"):
        check_same_grid(g, g.where("lat > 0")).count()


def test_relabel_by_position(spark):
    ref = spark.createDataFrame([(dt.datetime(2001, 1, 1),)], "time timestamp")
    df = spark.createDataFrame([(1, dt.datetime(1999, 5, 31)), (1, dt.datetime(1999, 6, 30))],
                               "k int, time timestamp")
    out = sorted(r.time for r in relabel_by_position(ref, df).collect())
    assert out == [dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1)]


def test_stream_matches_batch_for_all_months(spark):
    """All months equal the batch first-value, the open one included; new files
    extend the result, and a rerun without any changes nothing."""
    from terracube.streaming import run_monthly_first
    daily = normalise_coordinate_names(load_daily_product(spark, SF))
    src = IO.scratch_path(spark, "t-daily")
    out, ck = IO.scratch_path(spark, "t-monthly"), IO.scratch_path(spark, "t-ck")
    batch = resample_first(daily, ["lat", "lon"], "value").withColumn("month", F.date_trunc("month", "time")).drop("time")
    want = {(r.lat, r.lon, r.month.replace(tzinfo=None)): r.value for r in batch.collect()}
    for part in ("year(time) >= 1998", "year(time) < 1998", None):
        if part:
            daily.where(part).write.mode("append").parquet(src)
        run_monthly_first(spark, src, daily.schema, ["lat", "lon"], "value", out, ck)
        got = {(r.lat, r.lon, r.month.replace(tzinfo=None)): r.value for r in spark.read.parquet(out).collect()}
        assert got == ({k: v for k, v in want.items() if k[2].year >= 1998} if part and ">=" in part else want)
