"""Cube merges (J1, J2) and prediction alignment.

J4 (subtracting the monthly climatology from every time step regardless of
its month) is the form the reference shows as wrong; it pairs every time
with every month per pixel, so it is not built.  J3 is the correct form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.schema import CUBE_KEYS, PIXEL_ID
from terracube.session import dealt


def merge_cubes(*cubes: DataFrame, keys: Sequence[str] = CUBE_KEYS) -> DataFrame:
    """Outer alignment of cubes on ``(lat, lon, time)``.

    A co-group instead of a chain of full outer joins: every cube is
    widened to the union of variables (NULL where it has none), the cubes
    are unioned, and one aggregate on the keys picks each variable from the
    cube that has it.  N cubes cost one shuffle instead of 2(N-1) join
    shuffles, and nothing is joined pairwise.  Rows are dealt by the keys first: a
    key occurs once per cube, so a map-side aggregate would hold every row of its
    task and combine none.  Keys are unique per cube, which a kept filter checks (a repeated
    key raises), so this equals the full outer join; variable names must be
    distinct.
    """
    if not cubes:
        raise ValueError("nothing to merge")
    keys = list(keys)
    names = [c for cube in cubes for c in cube.columns if c not in keys]
    if len(names) != len(set(names)):
        raise ValueError(f"variable names collide: {names}")
    if len(cubes) == 1:
        return cubes[0]
    types = {c: t for cube in cubes for c, t in cube.dtypes if c not in keys}
    parts = [cube.select(*keys, *[(F.col(c) if c in cube.columns else F.lit(None).cast(types[c])).alias(c)
                                  for c in names])
             for cube in cubes]
    u = parts[0].withColumn("__cube", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        u = u.unionByName(p.withColumn("__cube", F.lit(i)))
    most = F.greatest(*[F.count_if(F.col("__cube") == i) for i in range(len(cubes))])
    g = dealt(u, *keys).groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names], most.alias("__most"))
    return g.where(F.assert_true(F.col("__most") <= 1, "a key occurs twice in one cube").isNull()).drop("__most")


def align_predictions(preds: DataFrame, truth: DataFrame,
                      keys: Sequence[str] = ("lat", "lon", "gb_year")) -> DataFrame:
    """Predictions, truth and locations matched on keys, not on position.

    Inner-join semantics for inputs with unique keys per side.  When both
    sides carry the pixel hash of one clustered cube, the match is a
    co-group (union, then one aggregate on the keys): the aggregate runs on
    the existing pixel partitioning, so no side is shuffled again.
    Otherwise it is a plain equi join.
    """
    keys = list(keys)
    if PIXEL_ID not in preds.columns or PIXEL_ID not in truth.columns:
        return preds.join(truth, keys, "inner")
    gk = [PIXEL_ID, *keys]
    pc = [c for c in preds.columns if c not in gk]
    tc = [c for c in truth.columns if c not in gk]
    ptypes, ttypes = dict(preds.dtypes), dict(truth.dtypes)
    a = preds.select(*gk, *pc, *[F.lit(None).cast(ttypes[c]).alias(c) for c in tc], F.lit(True).alias("__p"))
    b = truth.select(*gk, *[F.lit(None).cast(ptypes[c]).alias(c) for c in pc], *tc, F.lit(False).alias("__p"))
    g = a.unionByName(b).groupBy(*gk).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in pc + tc],
        F.count_if("__p").alias("__hp"), F.count_if(~F.col("__p")).alias("__ht"))
    once = F.assert_true(F.greatest("__hp", "__ht") <= 1, "a key occurs twice on one side").isNull()
    return g.where(once & (F.col("__hp") > 0) & (F.col("__ht") > 0)).drop("__hp", "__ht")
