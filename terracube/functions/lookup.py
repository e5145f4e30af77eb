"""Land-cover class lookup.

Fixed values (must equal the reference pipeline): the 23 land-cover codes
with their long label, short label and coarse class, then the coarse class
to integer id mapping.  Listed in natural order.
"""

from __future__ import annotations

# code, long label, short label, coarse class
LANDCOVER = [
    (11, "Post-flooding or irrigated croplands", "irrigated croplands", "cropland"),
    (14, "Rainfed croplands", "Rainfed croplands", "cropland"),
    (20, "Mosaic cropland (50-70%) / vegetation (grassland, shrubland, forest) (20-50%)", "cropland/vegetation", "cropland"),
    (30, "Mosaic vegetation (grassland, shrubland, forest) (50-70%) / cropland (20-50%)", "vegetation/cropland", "cropland"),
    (40, "Closed to open (>15%) broadleaved evergreen and/or semi-deciduous forest (>5m)", "broad-leaved evergreen/semi-deciduous forest", "forest"),
    (50, "Closed (>40%) broadleaved deciduous forest (>5m)", "broad-leaved deciduous forest", "forest"),
    (60, "Open (15-40%) broadleaved deciduous forest (>5m)", "broad-leaved deciduous forest", "forest"),
    (70, "Closed (>40%) needleleaved evergreen forest (>5m)", "needle-leaved evergreen forest", "forest"),
    (90, "Open (15-40%) needleleaved deciduous or evergreen forest (>5m)", "needle-leaved deciduous / evergreen forest", "forest"),
    (100, "Closed to open (>15%) mixed broadleaved and needleleaved forest (>5m)", "broad-leaved / needleleaved forest", "forest"),
    (110, "Mosaic forest-shrubland (50-70%) / grassland (20-50%)", "forest-shrubland / grassland", "shrubland/grassland"),
    (120, "Mosaic grassland (50-70%) / forest-shrubland (20-50%)", "Mosaic grassland / forest-shrubland", "shrubland/grassland"),
    (130, "Closed to open (>15%) shrubland (<5m)", "shrubland", "shrubland"),
    (140, "Closed to open (>15%) grassland", "grassland", "grassland"),
    (150, "Sparse (>15%) vegetation (woody vegetation, shrubs, grassland)", "Sparse vegetation", "Sparse vegetation"),
    (160, "Closed (>40%) broadleaved forest regularly flooded - Fresh water", "forest regularly flooded - Fresh water", "flooded"),
    (170, "Closed (>40%) broadleaved semi-deciduous and/or evergreen forest regularly flooded - saline water", "forest regularly flooded - saline water", "flooded"),
    (180, "Closed to open (>15%) vegetation (grassland, shrubland, woody vegetation) on regularly flooded or waterlogged soil", "vegetation on flooded soil", "flooded"),
    (190, "Artificial surfaces and associated areas (urban areas >50%) GLOBCOVER 2009", "Artificial", "Artificial"),
    (200, "Bare areas", "Bare areas", "Bare areas"),
    (210, "Water bodies", "Water bodies", "Water bodies"),
    (220, "Permanent snow and ice", "Permanent snow and ice", "Permanent snow and ice"),
    (230, "Unclassified", "Unclassified", "Unclassified"),
]

# coarse class -> integer id
CLASS_IDS = [
    ("cropland", 2),
    ("forest", 3),
    ("shrubland/grassland", 4),
    ("shrubland", 5),
    ("grassland", 6),
    ("Sparse vegetation", 7),
    ("flooded", 8),
    ("Artificial", 9),
    ("Bare areas", 10),
    ("Water bodies", 11),
    ("Permanent snow and ice", 12),
    ("Unclassified", 13),
]


def landcover_dimension(spark):
    """The lookup as a 23-row dimension frame (bounded, safe to broadcast)."""
    ids = dict(CLASS_IDS)
    rows = [(c, lab, short, cls, ids[cls]) for c, lab, short, cls in LANDCOVER]
    return spark.createDataFrame(
        rows, "code int, label string, short_label string, class string, class_id int")


def class_id_to_name(spark):
    """F11 inversion: integer id -> coarse class."""
    return spark.createDataFrame([(i, c) for c, i in CLASS_IDS], "class_id int, class string")
