"""The quadtree cover against ray casting over all edges."""

import numpy as np
from pyspark.sql import functions as F

from terracube.functions.geo import quadtree_cover, ring_crossings
from terracube.operators.lookup import clip_to_regions

REGION = "country string, rings array<array<struct<lon:double,lat:double>>>"


def star(rng, cx, cy, r, n):
    a = np.sort(rng.uniform(0, 2 * np.pi, n))
    return [(float(cx + r * u * np.cos(t)), float(cy + r * u * np.sin(t))) for t, u in zip(a, rng.uniform(0.4, 1.0, n), strict=True)]


def frame(spark, regions):
    return spark.createDataFrame([(n, [[{"lon": x, "lat": y} for x, y in ring] for ring in rings]) for n, rings in regions], REGION)


def test_cover_equals_ray_casting(spark):
    rng = np.random.default_rng(8)
    regions = [(f"r{i}", [star(rng, cx, cy, r, n), star(rng, cx, cy, r / 3, 12)]) for i, (cx, cy, r, n) in enumerate(
        [(0, 0, 5, 400), (3, 1, 4, 30), (-100, 60, 20, 200), (170, -80, 9, 50), (0.05, 0.05, 0.02, 60)])]
    regions += [("two", [star(rng, 20, 20, 2, 20), star(rng, 26, 20, 2, 20)]), ("box", [[(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0)]]), ("none", [])]
    at = np.concatenate([rng.uniform(-6, 8, (3000, 2)), rng.uniform(-0.1, 0.2, (300, 2)), rng.uniform([-130, 30], [-70, 90], (1000, 2)), rng.uniform([150, -90], [180, -60], (500, 2)),
                         rng.uniform(16, 30, (600, 2)), np.stack(np.meshgrid(np.arange(0, 4.25, 0.25), np.arange(0, 4.25, 0.25)), -1).reshape(-1, 2)])  # points on the box's edges too
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(at)], "id int, lon double, lat double")
    r = frame(spark, regions)
    crossings = F.aggregate(F.transform("rings", lambda ring: ring_crossings(F.col("lon"), F.col("lat"), ring)), F.lit(0), lambda a, n: a + n)
    want = {(x.id, x.country) for x in points.join(F.broadcast(r.where(F.size("rings") > 0))).where(crossings % 2 == 1).collect()}
    for depth, few in ((13, 8), (9, 0), (4, 50)):
        got = [(x.id, x.country) for x in clip_to_regions(points, r, depth, few).collect()]
        assert set(got) == want and len(got) == len(want) > 1500, (depth, few)


def test_cells_hold_few_edges(spark):
    rng = np.random.default_rng(9)
    turn = np.linspace(0, 2 * np.pi, 5000, endpoint=False)
    ring = [(float(10 + u * np.cos(t)), float(5 + u * np.sin(t))) for t, u in zip(turn, 8 + 0.002 * rng.standard_normal(5000), strict=True)]
    cover = quadtree_cover(frame(spark, [("r", [ring])])).select(F.size("edges").alias("n"), F.shiftright("key", 56).alias("level")).toPandas()
    inner = cover[cover["n"] == 0]
    assert len(inner) > 100 and inner["level"].nunique() > 3  # inside cells are as large as the border lets them
    shallow = cover[cover["level"] < 13]
    assert shallow["n"].max() <= 8 and cover["n"].sum() < 4 * len(ring)


def test_points_in_inside_cells_meet_no_edge(spark):
    box = frame(spark, [("box", [[(0.0, 0.0), (0.0, 40.0), (40.0, 40.0), (40.0, 0.0)]])])
    points = spark.createDataFrame([(20.0, 20.0), (41.0, 20.0)], "lon double, lat double")
    cover = quadtree_cover(box)
    assert cover.where("size(edges) > 0").agg(F.max(F.size("edges"))).first()[0] <= 4
    assert [(r.lon, r.lat) for r in clip_to_regions(points, box).collect()] == [(20.0, 20.0)]
    assert clip_to_regions(points.limit(0), box).count() == 0 and clip_to_regions(points, box.limit(0)).count() == 0
