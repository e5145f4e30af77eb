"""Regrid (J5, J6), merge (J1), lookup (J10), clip."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terracube.operators.lookup import classify_landcover, clip_to_regions
from terracube.operators.merge import merge_cubes
from terracube.operators.regrid import bilinear_weights, nearest_map, regrid_bilinear, regrid_nearest


def _axis(spark, vals):
    return spark.createDataFrame([(float(v),) for v in vals], "v double")


def test_bilinear_axis_weights(spark):
    w = bilinear_weights(_axis(spark, [0, 0.5, 1]), _axis(spark, [0, 0.25, 0.9, 1, 1.3])).collect()
    left = {}
    for r in w:
        left.setdefault(r.dst, []).append((r.src, r.w))
    first = {d: min(p)[1] for d, p in left.items()}
    assert first[0.0] == 1.0 and first[0.25] == pytest.approx(0.5)
    assert first[0.9] == pytest.approx(0.2) and first[1.0] == 1.0
    assert 1.3 not in first
    for d, p in left.items():
        assert sum(x for _, x in p) == pytest.approx(1.0)


def _cell(spark, vals):
    t = dt.datetime(2000, 1, 1)
    rows = [(0.0, 0.0, t, vals[0]), (0.0, 1.0, t, vals[1]), (1.0, 0.0, t, vals[2]), (1.0, 1.0, t, vals[3])]
    return spark.createDataFrame(rows, "lat double, lon double, time timestamp, v double")


def test_bilinear_centre(spark):
    out = regrid_bilinear(_cell(spark, [0.0, 1.0, 2.0, 3.0]), _axis(spark, [0.5]), _axis(spark, [0.5]), ["v"]).collect()
    assert out[0].v == pytest.approx(1.5)
    out = regrid_bilinear(_cell(spark, [0.0, None, 2.0, 3.0]), _axis(spark, [0.5]), _axis(spark, [0.5]), ["v"]).collect()
    assert out[0].v is None


def test_regrid_identity(spark):
    cube = _cell(spark, [0.0, 1.0, 2.0, 3.0])
    lat, lon = _axis(spark, [0, 1]), _axis(spark, [0, 1])
    a = sorted(regrid_bilinear(cube, lat, lon, ["v"]).collect())
    b = sorted(regrid_nearest(cube, lat, lon, ["v"]).collect())
    assert a == sorted(cube.collect()) == b


def test_nearest_tie_lower(spark):
    m = {r.dst: r.src for r in nearest_map(_axis(spark, [0, 1]), _axis(spark, [0.5, 0.6, -3, 9])).collect()}
    assert m == {0.5: 0.0, 0.6: 1.0, -3.0: 0.0, 9.0: 1.0}


def test_merge_idempotent_and_outer(spark):
    t1, t2 = dt.datetime(2000, 1, 1), dt.datetime(2000, 2, 1)
    a = spark.createDataFrame([(0.0, 0.0, t1, 1.0)], "lat double, lon double, time timestamp, a double")
    b = spark.createDataFrame([(0.0, 0.0, t2, 2.0)], "lat double, lon double, time timestamp, b double")
    m = merge_cubes(a, b).orderBy("time").collect()
    assert [(r.a, r.b) for r in m] == [(1.0, None), (None, 2.0)]
    with pytest.raises(ValueError):
        merge_cubes(a, a)


def test_class_lookup(spark):
    df = spark.createDataFrame([(11,), (140,), (999,)], "code int")
    out = {r.code: (r["class"], r.class_id) for r in classify_landcover(df).collect()}
    assert out == {11: ("cropland", 2), 140: ("grassland", 6), 999: (None, None)}


def test_clip_triangle(spark):
    pts = spark.createDataFrame([(0.2, 0.2), (0.9, 0.9), (0.1, 0.5)], "lat double, lon double")
    ring = [{"lon": 0.0, "lat": 0.0}, {"lon": 1.0, "lat": 0.0}, {"lon": 0.0, "lat": 1.0}]
    hole = [{"lon": 0.05, "lat": 0.15}, {"lon": 0.25, "lat": 0.15}, {"lon": 0.25, "lat": 0.25}, {"lon": 0.05, "lat": 0.25}]
    schema = "country string, rings array<array<struct<lon:double,lat:double>>>"
    for rings, want in (([ring], {(0.2, 0.2), (0.1, 0.5)}), ([ring, hole], {(0.1, 0.5)})):
        for depth in (13, 9):  # cells of a sixteenth of a degree and of one degree
            inside = {(r.lat, r.lon) for r in clip_to_regions(pts, spark.createDataFrame([("t", rings)], schema), depth).collect()}
            assert inside == want


def test_align_predictions_cogroup_equals_join(spark):
    from terracube.operators.clean import cluster_by_pixel
    from terracube.operators.merge import align_predictions
    from terracube.schema import PIXEL_ID
    from terracube.sources.grid import load_grid
    g = cluster_by_pixel(load_grid(spark, "/root/testdata/sf0.001"))
    p = g.select(PIXEL_ID, "lat", "lon", "time", F.col("evi").alias("prediction")).where("lat > 0")
    t = g.select(PIXEL_ID, "lat", "lon", "time", F.col("ndvi").alias("y")).where("lon > 1")
    a = align_predictions(p, t, ["lat", "lon", "time"]).drop(PIXEL_ID)
    b = align_predictions(p.drop(PIXEL_ID), t.drop(PIXEL_ID), ["lat", "lon", "time"])
    cols = ["lat", "lon", "time", "prediction", "y"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_axis_windows_run_forward_only(spark):
    src, dst = _axis(spark, [0, 0.5, 1]), _axis(spark, [0.25, 0.5, 0.9])
    plan = nearest_map(src, dst)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedfollowing" not in plan  # such a frame is evaluated anew for every row
    n = 3000
    got = {r.dst: r.src for r in nearest_map(spark.range(n).selectExpr("double(id) v"), spark.range(n).selectExpr("id + 0.7D v")).collect()}
    assert got == {i + 0.7: float(min(i + 1, n - 1)) for i in range(n)}


def test_bilinear_cells_are_dealt(spark):
    """The cells of a few steps come from many tasks, and each is there once."""
    from terracube.operators.regrid import _cells
    n = 3000  # more than a block of longitudes
    lat, lon = _axis(spark, [0.5, 1.5]), spark.range(n).selectExpr("id + 0.5D v")
    steps = spark.sql("SELECT timestamp_ntz'2000-01-01' AS time UNION ALL SELECT timestamp_ntz'2000-02-01'")
    per = _cells(steps, lat, lon, "time").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per) == 4 * n and max(r["count"] for r in per) < 4 * n / 2
    cube = spark.range(3).crossJoin(spark.range(n)).toDF("i", "k").selectExpr("double(i) lat", "double(k) lon", "timestamp_ntz'2000-01-01' time", "double(2 * i + k) v")
    got = {(r.lat, r.lon, r.time.month): r.v for r in regrid_bilinear(cube, lat, lon, ["v"], times=steps).collect()}
    assert got == {(a, k + 0.5, m): pytest.approx(2 * a + k + 0.5) if m == 1 and k < n - 1 else None for a in (0.5, 1.5) for k in range(n) for m in (1, 2)}
    none = regrid_bilinear(cube, lat, lon.limit(0), ["v"], times=steps)
    assert none.count() == 0


def test_bilinear_has_no_partial_aggregate(spark):
    out = regrid_bilinear(_cell(spark, [0.0, 1.0, 2.0, 3.0]), _axis(spark, [0.5]), _axis(spark, [0.5]), ["v"])
    assert "hashpartitioning(lat" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "REPARTITION_BY_NUM" in plan

def test_merge_deals_rows_before_its_aggregate(spark):
    """Keys are unique per cube: a map-side aggregate would hold all rows of a task and combine none."""
    t = dt.datetime(2000, 1, 1)
    a = spark.createDataFrame([(0.0, 0.0, t, 1.0)], "lat double, lon double, time timestamp, a double")
    m = merge_cubes(a, a.withColumnRenamed("a", "b"))
    assert "REPARTITION_BY_NUM" in m._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r)[3:] for r in m.collect()] == [(1.0, 1.0)]
