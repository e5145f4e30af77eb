"""Point geometry and ray casting as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_point(df: DataFrame, lat: str = "lat", lon: str = "lon", crs: str = "EPSG:4326") -> DataFrame:
    """``geometry struct<lon, lat>`` (x = lon, y = lat) plus its CRS."""
    return df.withColumns({"geometry": F.struct(F.col(lon).alias("lon"), F.col(lat).alias("lat")),
                           "crs": F.lit(crs)})


def ring_crossings(x: Column, y: Column, ring: Column) -> Column:
    """Edges of a closed or open ring of ``struct<lon, lat>`` that a ray from the point
    crosses; the point is inside when the count over all rings is odd.

    For edge (i, j = i-1): crosses when ``(yi > y) != (yj > y)`` and
    ``x < (xj - xi) * (y - yi) / (yj - yi) + xi``.
    """
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 1)

    def step(acc, i):
        j = F.when(i == 0, n - 1).otherwise(i - 1)
        pi, pj = F.element_at(ring, i + 1), F.element_at(ring, j + 1)
        xi, yi, xj, yj = pi["lon"], pi["lat"], pj["lon"], pj["lat"]
        cross = ((yi > y) != (yj > y)) & (x < F.try_divide((xj - xi) * (y - yi), yj - yi) + xi)
        return acc + F.when(cross, 1).otherwise(0)

    return F.aggregate(idx, F.lit(0), step)


# A quadtree over the plane: cells of side SPAN / 2^level from a corner that no coordinate of few decimals meets.
SPAN = 512.0
CORNER = -256.000123456789
DEPTH, FEW = 13, 8


def cell_key(level: Column, cx: Column, cy: Column) -> Column:
    return F.shiftleft(level.cast("long"), 56).bitwiseOR(F.shiftleft(cx.cast("long"), 28)).bitwiseOR(cy.cast("long"))


def point_cells(lon: Column, lat: Column, depth: int = DEPTH) -> Column:
    """The keys of the cells of every level that hold a point."""
    at = lambda v: F.floor((v - F.lit(CORNER)) * (2**depth / SPAN))
    return F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda k: cell_key(
        k, F.floor(at(lon) / F.pow(F.lit(2.0), F.lit(depth) - k)), F.floor(at(lat) / F.pow(F.lit(2.0), F.lit(depth) - k))))


def _crosses(e: Column, x: Column, y: Column, ax: Column, ay: Column) -> Column:
    """1 if the edge changes the parity between ``(x, y)`` and ``(ax, ay)``: along the first point's row, then
    along the second one's column. The row is the rule of ``ring_crossings``."""
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    row = F.try_divide((x2 - x1) * (y - y1), y2 - y1) + x1
    column = F.try_divide((y2 - y1) * (ax - x1), x2 - x1) + y1
    along = ((y1 > y) != (y2 > y)) & ((row > x) != (row > ax))
    up = ((x1 > ax) != (x2 > ax)) & ((column > y) != (column > ay))
    return F.when(along, 1).otherwise(0) + F.when(up, 1).otherwise(0)


def path_parity(edges: Column, x: Column, y: Column, ax: Column, ay: Column) -> Column:
    """Parity of the edges between two points of a cell that holds all edges given."""
    return F.aggregate(edges, F.lit(0), lambda n, e: n + _crosses(e, x, y, ax, ay)) % 2


def _touches(e: Column, x0: Column, y0: Column, side: Column) -> Column:
    """The edge may reach into the cell: their boxes meet, and the cell is not on one side of the edge's line."""
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    boxes = (F.least(x1, x2) <= x0 + side) & (F.greatest(x1, x2) >= x0) & (F.least(y1, y2) <= y0 + side) & (F.greatest(y1, y2) >= y0)
    middle = (x2 - x1) * (y0 + side / 2 - y1) - (y2 - y1) * (x0 + side / 2 - x1)
    reach = (F.abs(x2 - x1) + F.abs(y2 - y1)) * side / 2
    return boxes & (F.abs(middle) <= reach * (1 + 1e-9) + 1e-12)


def quadtree_cover(regions: DataFrame, depth: int = DEPTH, few: int = FEW) -> DataFrame:
    """``country, key, ax, ay, parity, edges``: the leaves of each region's quadtree that reach inside it.

    A cell is divided while more than ``few`` edges reach into it, down to ``depth``. A leaf without edges lies
    inside in whole. Any other holds just the edges that reach into it, and the parity of its lower left corner
    (its anchor), which follows from the parent's anchor and the parent's edges alone.
    """
    ends = F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p, i: F.struct(
        p["lon"].alias("x1"), p["lat"].alias("y1"), F.element_at(r, F.when(i == 0, F.size(r)).otherwise(i))["lon"].alias("x2"),
        F.element_at(r, F.when(i == 0, F.size(r)).otherwise(i))["lat"].alias("y2")))))
    c = lambda n: F.col("cell")[n]
    zero = F.lit(0).cast("long")
    cells = regions.select("country", F.struct(F.lit(0).alias("level"), zero.alias("cx"), zero.alias("cy"), F.lit(0).alias("parity"), ends.alias("edges")).alias("cell"))
    corner = lambda n, side: F.col("cell")[n] * side + F.lit(CORNER)
    side = F.lit(SPAN) / F.pow(F.lit(2.0), c("level"))
    half, ax, ay = side / 2, corner("cx", side), corner("cy", side)

    def quarter(k: Column) -> Column:
        cx, cy = c("cx") * 2 + k % 2, c("cy") * 2 + F.floor(k / 2)
        x0, y0 = cx * half + F.lit(CORNER), cy * half + F.lit(CORNER)
        parity = (c("parity") + path_parity(c("edges"), x0, y0, ax, ay)) % 2
        return F.struct((c("level") + 1).alias("level"), cx.cast("long").alias("cx"), cy.cast("long").alias("cy"), parity.cast("int").alias("parity"),
                        F.filter(c("edges"), lambda e: _touches(e, x0, y0, half)).alias("edges"))

    whole = (F.size(c("edges")) <= few) & (c("level") > 0)  # a leaf, then and in all later rounds
    divided = F.explode(F.when(whole, F.array("cell")).otherwise(F.transform(F.sequence(F.lit(0), F.lit(3)), quarter))).alias("cell")
    for _ in range(depth):
        cells = cells.select("country", divided).where("size(cell.edges) > 0 OR cell.parity = 1")
    return cells.select("country", cell_key(c("level"), c("cx"), c("cy")).alias("key"), ax.alias("ax"), ay.alias("ay"),
                        c("parity").alias("parity"), c("edges").alias("edges"))
