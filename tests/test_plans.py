"""Plan-shape guards for the scale design (read from executed plans)."""

import re

from pyspark.sql import functions as F

from terracube.operators import slicing as SL
from terracube.sources import io as IO
from terracube.sources.grid import load_grid

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()      # run so AQE finalises
    return df._jdf.queryExecution().executedPlan().toString()


def _window_exchanges(df):
    """Exchanges whose hash keys include the pixel hash or lat/lon (pixel
    shuffles), excluding the grid aggregate's own exchange."""
    df.write.format("noop").mode("overwrite").save()
    txt = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in txt.splitlines() if "Exchange hashpartitioning" in ln
            and ("__pix" in ln or "lat" in ln)]


def test_example_pipeline_shuffles_pixels_once_per_pass(spark):
    import __spark_entry__ as E
    df = E.queries()["pixel_year_examples"](spark, SF)
    ex = _window_exchanges(df)
    # one pixel exchange feeds anomaly and example windows; the global statistics are a pass of their own
    numbers = {re.search(r"plan_id=(\d+)", ln).group(1) for ln in ex if "__pix" in ln and "Reused" not in ln}
    assert len(numbers) <= 2, ex
    assert not any("gb_year" in ln for ln in ex), ex


def test_drought_pass_has_no_join_back(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["drought_lags"](spark, SF))
    assert "SortMergeJoin" not in p


def test_grid_scan_prunes_columns(spark):
    p = _plan(load_grid(spark, SF).select("lat", "ndvi"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas
    for s in schemas:
        assert "l_returnflag" not in s and "l_partkey" not in s


def test_written_cube_prunes_and_pushes(spark):
    g = load_grid(spark, SF)
    path = IO.scratch_path(spark, "t-plan-cube")
    IO.write_cube(g, path)
    q = IO.read_cube(spark, path).where((F.col("year") == 1999) & (F.col("lat") <= 0.5))
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in p
    assert "PushedFilters" in p and "LessThanOrEqual(lat,0.5)" in p


def test_regrid_has_no_pairwise_join(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["regrid_bilinear"](spark, SF))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_results_do_not_depend_on_broadcasts(spark):
    """Axis, calendar and region tables without any broadcast: the same rows."""
    import __spark_entry__ as E
    for name in ("regrid_bilinear", "regrid_nearest", "flip_lat", "clip_polygon", "band_unpivot", "drought_lags"):
        query = E.queries()[name]
        a = sorted(map(repr, query(spark, SF).collect()))
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert sorted(map(repr, query(spark, SF).collect())) == a, name
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_reference_bounds_reach_the_scan(spark):
    g = load_grid(spark, SF)
    path = IO.scratch_path(spark, "t-bounds")
    IO.write_cube(g, path, partition_by_year=False)
    cube = IO.read_cube(spark, path)
    for df in (SL.bbox_from_reference(g.where("lat > 0.2"), cube), SL.time_slice_from_reference(g.where("year(time) = 1999"), cube),
               SL.time_slice_exact(g, cube)):
        p = _plan(df)
        scan = [ln.split("DataFilters")[1] for ln in p.splitlines() if "FileScan" in ln and "DataFilters" in ln]
        assert any("ubquery" in x for x in scan), scan


def test_quantiles_have_no_window_over_all_rows(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["quantiles"](spark, SF))
    windows = [ln for ln in p.splitlines() if re.search(r"\bWindow \[", ln)]
    # running sums of counts (__c) over digits (__d), never over values
    assert len(windows) >= 4 and all("sum(__c" in ln and "__v" not in ln.split("windowspecdefinition", 1)[1].split("ROW")[0] for ln in windows)
