"""Space-time layout (S7/S1) and dense tiles."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracube.sources import io as IO
from terracube.sources import layout as LY
from terracube.sources import tiles as TL

CUBE = "lat double, lon double, time timestamp_ntz, v double"


def cube(spark, n_lat=20, n_lon=30, n_time=24):
    rows = [(a * 0.25 - 2, o * 0.25 - 3, dt.datetime(2000 + t // 12, 1 + t % 12, 1), None if (a + o + t) % 7 == 0 else float(a * 10_000 + o * 100 + t))
            for a in range(n_lat) for o in range(n_lon) for t in range(n_time)]
    return spark.createDataFrame(rows, CUBE).repartition(6)


def test_key_interleaves_bits(spark):
    rows = [(0.0, 0.0, dt.datetime(2000, 1, 1)), (89.9, -180.0, dt.datetime(1, 1, 1)), (-90.0, 179.99, dt.datetime(2021, 7, 1))]
    for r in spark.createDataFrame(rows, "lat double, lon double, time timestamp_ntz").select("*", LY.morton_key(F.col("lat"), F.col("lon"), F.col("time")).alias("k")).collect():
        parts = [int((r.lat + 90) / 180 * 65536), int((r.lon + 180) % 360 / 360 * 65536), r.time.year * 12 + r.time.month - 1]
        assert r.k == sum(((p >> b) & 1) << (3 * b + i) for i, p in enumerate(parts) for b in range(16))


def test_box_opens_only_its_files(spark):
    df, path = cube(spark), IO.scratch_path(spark, "t-blocks")
    LY.write_cube_blocks(df, path, files=24)
    bounds = spark.read.parquet(f"{path}/bounds").collect()
    assert len(bounds) >= 20 and sum(b.n for b in bounds) == df.count()
    box = {"lat": (0.0, 0.75), "lon": (-1.0, 0.0), "time": ("2000-03-01", "2000-08-01")}
    got = LY.read_cube_blocks(spark, path, **box)
    lo, hi = dt.datetime(2000, 3, 1), dt.datetime(2000, 8, 1)
    meet = {b.file for b in bounds if b.lat_max >= 0 and b.lat_min <= 0.75 and b.lon_max >= -1 and b.lon_min <= 0 and b.time_max >= lo and b.time_min <= hi}
    assert {f.rsplit("/", 1)[-1] for f in got.inputFiles()} == {f.rsplit("/", 1)[-1] for f in meet} and len(meet) < len(bounds) / 3
    want = df.where(F.col("lat").between(0.0, 0.75) & F.col("lon").between(-1.0, 0.0) & F.col("time").between(F.lit(lo), F.lit(hi)))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr) and got.count() == 4 * 5 * 6
    assert "PushedFilters: [IsNotNull(lat)" in got._jdf.queryExecution().toString()
    assert LY.read_cube_blocks(spark, path, lat=(50.0, 60.0)).count() == 0
    assert LY.read_cube_blocks(spark, path).count() == df.count()


def test_tiles_hold_all_cells_of_their_block(spark):
    df = cube(spark, 5, 7, 9).where("NOT (lat = -2 AND lon > -2)")
    on = TL.axes(df)
    tiles = TL.to_tiles(df, "v", (2, 3, 4), on)
    rows = {(r.lat_from, r.lon_from, r.time_from): r for r in tiles.collect()}
    assert len(rows) == 3 * 3 * 3 and rows[4, 6, 8]["shape"] == [1, 1, 1] and rows[0, 0, 0]["shape"] == [2, 3, 4]
    want = {(round((r.lat + 2) * 4), round((r.lon + 3) * 4), (r.time.year - 2000) * 12 + r.time.month - 1): r.v for r in df.collect()}
    for (a, o, t), r in rows.items():
        values = np.array(r["values"], dtype=object).reshape(r["shape"])
        for (i, j, k), v in np.ndenumerate(values):
            assert v == want.get((a + i, o + j, t + k))
        assert r.valid == [v is not None for v in r["values"]]
    back = TL.from_tiles(tiles, on, "v")
    assert sorted(back.collect()) == sorted(df.where("v IS NOT NULL").collect())


def test_neighbourhood_comes_from_one_tile(spark):
    df = cube(spark, 8, 9, 12)
    on = TL.axes(df)
    tiles = TL.to_tiles(df, "v", (4, 3, 12), on)
    (one,) = TL.cut_tiles(tiles, (5, 8), (3, 6), (2, 5)).collect()
    assert (one.lat_from, one.lon_from, one.time_from, one["shape"], len(one["values"])) == (5, 3, 2, [3, 3, 3], 27)
    cut = TL.cut_tiles(tiles, (3, 6), (1, 8), (0, 12))
    at = lambda d, lo, hi: F.col(d).isin([r[d] for r in on[d].where(f"__{d} >= {lo} AND __{d} < {hi}").collect()])
    want = df.where(at("lat", 3, 6) & at("lon", 1, 8) & F.col("v").isNotNull())
    assert sorted(TL.from_tiles(cut, on, "v").collect()) == sorted(want.collect()) and cut.count() == 6
    assert TL.cut_tiles(tiles, (20, 30), (0, 3), (0, 3)).count() == 0


def test_repeated_cells_raise(spark):
    df = cube(spark, 2, 2, 2)
    with pytest.raises(Exception, match="twice"):
        TL.to_tiles(df.unionByName(df.limit(1)), "v").collect()
    assert TL.to_tiles(df.limit(0), "v").count() == 0
