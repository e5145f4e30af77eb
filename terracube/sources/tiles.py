"""Dense tiles of a cube (S12): arrays over blocks of latitude, longitude and time.

A tile holds the cells of one (latitude block, longitude block, time block) as an array in
row-major order, with its origin, its shape (blocks at the border are shorter) and a mask of
the cells that have a value. Positions are those on the cube's axes, which are as long as the
grid's dimensions. A tile is as large as its block, whatever the cube's size, so the arrays
are bounded; a slice opens the tiles that it meets and cuts them without a row per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = ("lat", "lon", "time")
BLOCK = (16, 16, 12)


def axes(df: DataFrame) -> dict[str, DataFrame]:
    """Each dimension's sorted distinct values with their positions."""
    out = {}
    for d in DIMENSIONS:
        out[d] = df.select(d).distinct().select(d, (F.row_number().over(Window.orderBy(d)) - 1).cast("int").alias(f"__{d}"))
    return out


def to_tiles(df: DataFrame, var: str, block: Sequence[int] = BLOCK, on: dict[str, DataFrame] | None = None) -> DataFrame:
    """``lat_from, lon_from, time_from`` (positions), ``shape``, ``values``, ``valid``: a row per tile with a cell.

    A cell that occurs twice raises; a cell that is missing or NULL is not valid."""
    on = on or axes(df)
    rows = df.select(*DIMENSIONS, F.col(var).alias("__v"))
    for d in DIMENSIONS:
        rows = rows.join(on[d], d)
    first = [(F.col(f"__{d}") - F.col(f"__{d}") % b).cast("int").alias(f"{d}_from") for d, b in zip(DIMENSIONS, block, strict=True)]
    inner = [F.col(f"__{d}") % b for d, b in zip(DIMENSIONS, block, strict=True)]
    place = ((inner[0] * block[1] + inner[1]) * block[2] + inner[2]).alias("p")
    cells = rows.groupBy(*first).agg(F.collect_list(F.struct(place, F.col("__v").alias("v"))).alias("c"))  # a block's cells at most
    cells = cells.where(F.assert_true(F.size("c") == F.size(F.array_distinct("c.p")), "a cell occurs twice in the cube").isNull())
    for d in DIMENSIONS:
        cells = cells.withColumn(f"__n_{d}", on[d].agg(F.count("*")).scalar())
    shape = F.array(*[F.least(F.lit(b).cast("long"), F.col(f"__n_{d}") - F.col(f"{d}_from")).cast("int") for d, b in zip(DIMENSIONS, block, strict=True)])
    held = cells.select("lat_from", "lon_from", "time_from", shape.alias("shape"), F.map_from_entries("c").alias("m"))
    n = [F.col("shape")[k] for k in range(3)]
    cell = lambda i: ((F.floor(i / (n[1] * n[2])) * block[1] + F.floor(i / n[2]) % n[1]) * block[2] + i % n[2]).cast("int")
    held = held.withColumn("values", F.transform(F.sequence(F.lit(0), n[0] * n[1] * n[2] - 1), lambda i: F.try_element_at("m", cell(i))))
    return held.select("lat_from", "lon_from", "time_from", "shape", "values", F.transform("values", lambda v: v.isNotNull()).alias("valid"))


def from_tiles(tiles: DataFrame, on: dict[str, DataFrame], var: str) -> DataFrame:
    """The cube's rows again: ``lat, lon, time`` and the variable where it is valid."""
    n = [F.col("shape")[k] for k in range(3)]
    at = tiles.select("lat_from", "lon_from", "time_from", "shape", F.posexplode("values").alias("i", var)).where(F.col(var).isNotNull())
    i = F.col("i")
    rows = at.select((F.col("lat_from") + F.floor(i / (n[1] * n[2]))).cast("int").alias("__lat"), (F.col("lon_from") + F.floor(i / n[2]) % n[1]).cast("int").alias("__lon"),
                     (F.col("time_from") + i % n[2]).cast("int").alias("__time"), var)
    for d in DIMENSIONS:
        rows = rows.join(on[d], f"__{d}")
    return rows.select(*DIMENSIONS, var)


def cut_tiles(tiles: DataFrame, lat: tuple[int, int], lon: tuple[int, int], time: tuple[int, int]) -> DataFrame:
    """The tiles of a box of positions (inclusive, exclusive), cut to it: arrays in, arrays out."""
    wanted = dict(zip(DIMENSIONS, (lat, lon, time), strict=True))
    df, n = tiles, [F.col("shape")[k] for k in range(3)]
    for k, d in enumerate(DIMENSIONS):
        (low, high), first = wanted[d], F.col(f"{d}_from")
        df = df.where((first < high) & (first + n[k] > low))
        df = df.withColumns({f"__low_{d}": F.greatest(F.lit(low), first) - first, f"__high_{d}": F.least(F.lit(high), first + n[k]) - first})
    inside = lambda i, d: (i >= F.col(f"__low_{d}")) & (i < F.col(f"__high_{d}"))
    keep = lambda i: inside(F.floor(i / (n[1] * n[2])), "lat") & inside(F.floor(i / n[2]) % n[1], "lon") & inside(i % n[2], "time")
    cut = df.select(*[(F.col(f"{d}_from") + F.col(f"__low_{d}")).cast("int").alias(f"__{d}") for d in DIMENSIONS],
                    F.array(*[(F.col(f"__high_{d}") - F.col(f"__low_{d}")).cast("int") for d in DIMENSIONS]).alias("__shape"),
                    *[F.filter(c, lambda v, i: keep(i)).alias(f"__{c}") for c in ("values", "valid")])
    return cut.select(*[F.col(f"__{d}").alias(f"{d}_from") for d in DIMENSIONS], *[F.col(f"__{c}").alias(c) for c in ("shape", "values", "valid")])
