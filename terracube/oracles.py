"""DuckDB SQL oracles for the registered queries.

Each oracle is written independently of the Spark code, against the raw
driver tables.  ``GRID`` is the derived monthly cube (DuckDB dialect).
"""

GRID = """
grid AS (
  WITH c AS (
    SELECT l_suppkey % 5 AS iy,
           (l_suppkey // 5) * 2 + l_linenumber % 2 AS ix,
           date_trunc('month', l_shipdate) AS time,
           count(*) AS n,
           CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS q,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS p,
           CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS d,
           CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS t,
           CAST(sum(l_orderkey) AS BIGINT) AS ok
    FROM lineitem GROUP BY 1, 2, 3)
  SELECT CAST(iy AS DOUBLE) * 25e-2 AS lat,
         CAST(ix AS DOUBLE) * 25e-2 AS lon,
         CAST(time AS TIMESTAMP) AS time,
         CASE WHEN ok % 53 = 0 THEN 2e2 ELSE (q * 100 // n) / 1e2 END AS lst_day,
         CASE WHEN ok % 59 = 0 THEN 2e2 ELSE (q * 60 // n) / 1e2 END AS lst_night,
         (p // (n * 1000)) / 1e2 AS precip,
         CASE WHEN ok % 61 = 0 THEN NULL ELSE (t * 50 // n) / 1e3 END AS sm,
         (d * 100 // n) / 1e3 AS ndvi,
         ((d * 60 + t * 10) // n) / 1e3 AS evi
  FROM c)"""

# Clean (C8) with pred_month 6, climatology years < 2001, target ndvi.
CLEAN = GRID + """,
rel AS (
  SELECT *, CAST(month(time - INTERVAL 6 MONTH) AS INTEGER) AS gb_month,
            CAST(year(time - INTERVAL 6 MONTH) + 1 AS INTEGER) AS gb_year,
            CASE WHEN lst_day < 200 THEN lst_day END AS lst_day_m,
            CASE WHEN lst_night < 200 THEN lst_night END AS lst_night_m
  FROM grid),
anom AS (
  SELECT lat, lon, time, gb_year, gb_month, lst_night_m AS lst_night, lst_day_m AS lst_day,
         precip, sm, ndvi, evi,
         ndvi - avg(CASE WHEN year(time) < 2001 THEN ndvi END)
                  OVER (PARTITION BY lat, lon, month(time)) AS ndvi_anomaly
  FROM rel),
cleaned AS (
  SELECT * FROM anom
  WHERE lat IS NOT NULL AND lon IS NOT NULL AND time IS NOT NULL
    AND lst_night IS NOT NULL AND lst_day IS NOT NULL AND precip IS NOT NULL
    AND sm IS NOT NULL AND ndvi IS NOT NULL AND evi IS NOT NULL
    AND ndvi_anomaly IS NOT NULL)"""

VALUE_COLS = ["lst_night", "lst_day", "precip", "sm", "ndvi", "evi", "ndvi_anomaly"]

SCALED = CLEAN + """,
st AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in VALUE_COLS) + """ FROM cleaned),
scaled AS (
  SELECT lat, lon, time, gb_year, gb_month, ndvi AS target, """ + ", ".join(
    f"({c} - m_{c}) / nullif(s_{c}, 0) AS {c}" for c in VALUE_COLS) + """
  FROM cleaned, st)"""

EXAMPLES = SCALED + """,
counted AS (
  SELECT *, count(*) OVER (PARTITION BY lat, lon, gb_year) AS n_rows,
         row_number() OVER (PARTITION BY lat, lon, gb_year ORDER BY gb_month, time) AS step
  FROM scaled),
full12 AS (
  SELECT *, max(CASE WHEN step = 12 THEN target END) OVER (PARTITION BY lat, lon, gb_year) AS y
  FROM counted WHERE n_rows = 12),
steps AS (
  SELECT lat, lon, gb_year,
         CASE WHEN gb_year = 2001 THEN 'test' ELSE 'train' END AS split,
         CAST(step AS INTEGER) AS step, """ + ", ".join(VALUE_COLS) + """, y
  FROM full12 WHERE step < 12 AND gb_year <= 2001)"""


def r6(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


ORACLES: dict[str, str] = {}

ORACLES["example_summary"] = "WITH " + EXAMPLES + """
SELECT gb_year, split, count(*) AS n_examples, round(avg(y), 6) AS mean_y
FROM steps WHERE step = 1 GROUP BY gb_year, split"""

ORACLES["cube_clean"] = "WITH " + CLEAN + """
SELECT lat, lon, time, gb_year, gb_month, lst_night, lst_day, precip, sm, ndvi, evi,
       round(ndvi_anomaly, 6) AS ndvi_anomaly
FROM cleaned"""

ORACLES["normalising_stats"] = "WITH " + CLEAN + """
SELECT variable, round(mean, 6) AS mean, round(std, 6) AS std FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, avg({c}) AS mean, stddev_samp({c}) AS std FROM cleaned"
    for c in VALUE_COLS) + ")"

ORACLES["zscore"] = "WITH " + SCALED + """
SELECT lat, lon, time, gb_year, gb_month, target, """ + r6(VALUE_COLS) + """
FROM scaled"""

ORACLES["pixel_year_examples"] = "WITH " + EXAMPLES + """
SELECT lat, lon, gb_year, split, step, """ + r6(VALUE_COLS) + """, y FROM steps"""

GV = ["lst_day", "lst_night", "precip", "sm", "ndvi", "evi"]

MASKED = GRID + """,
mg AS (
  SELECT lat, lon, time,
         CASE WHEN lst_day < 200 THEN lst_day END AS lst_day,
         CASE WHEN lst_night < 200 THEN lst_night END AS lst_night,
         precip, sm, ndvi, evi
  FROM grid)"""

ORACLES["climatology"] = "WITH " + GRID + """
SELECT lat, lon, CAST(month(time) AS INTEGER) AS month,
       round(avg(CASE WHEN year(time) < 2001 THEN ndvi END), 6) AS ndvi_clim
FROM grid GROUP BY lat, lon, month(time)"""

ORACLES["anomaly"] = "WITH " + GRID + """,
clim AS (SELECT lat, lon, month(time) AS month,
                avg(CASE WHEN year(time) < 2001 THEN ndvi END) AS c
         FROM grid GROUP BY 1, 2, 3)
SELECT g.lat, g.lon, g.time, round(g.ndvi - clim.c, 6) AS ndvi_anomaly
FROM grid g LEFT JOIN clim ON g.lat = clim.lat AND g.lon = clim.lon AND month(g.time) = clim.month"""

ORACLES["seasonal_max"] = "WITH " + GRID + """,
m AS (SELECT lat, lon, month(time) AS month, avg(ndvi) AS m FROM grid GROUP BY 1, 2, 3)
SELECT CAST(month AS INTEGER) AS month, round(max(m), 6) AS ndvi_max_monthly_mean FROM m GROUP BY month"""

ORACLES["time_mean"] = "WITH " + MASKED + """
SELECT lat, lon, """ + ", ".join(f"round(sum({c}), 6) / count({c}) AS {c}" for c in GV) + """
FROM mg GROUP BY lat, lon"""

ORACLES["describe"] = "WITH " + MASKED + """,
long AS (UNPIVOT mg ON """ + ", ".join(GV) + """ INTO NAME variable VALUE value)
SELECT variable, count(value) AS count, round(sum(value), 6) / count(value) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max
FROM long WHERE value IS NOT NULL GROUP BY variable"""

ORACLES["quantiles"] = "WITH " + GRID + """
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(ndvi, {q}), 6) AS quantile FROM grid"
    for q in (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)) + ")"

ORACLES["histogram"] = "WITH " + GRID + """,
b AS (SELECT min(ndvi) AS lo, max(ndvi) AS hi FROM grid),
k AS (SELECT CAST(CASE WHEN hi = lo THEN 1
                  ELSE least(floor((ndvi - lo) / (hi - lo) * 40) + 1, 40) END AS INTEGER) AS bucket
      FROM grid, b WHERE ndvi IS NOT NULL),
e AS (SELECT CAST(unnest(range(1, CASE WHEN hi > lo THEN 41 ELSE 2 END)) AS INTEGER) AS bucket, lo, hi FROM b)
SELECT e.bucket, (SELECT count(*) FROM k WHERE k.bucket = e.bucket) AS count, round(lo + (e.bucket - 1) * (hi - lo) / 40, 6) AS edge_lo
FROM e"""

ORACLES["distinct_counts"] = "WITH " + GRID + """
SELECT count(DISTINCT lat) AS n_lat, count(DISTINCT lon) AS n_lon,
       count(DISTINCT (lat, lon)) AS n_pixels, count(DISTINCT time) AS n_times,
       count(DISTINCT year(time)) AS n_years
FROM grid"""

ORACLES["percentile_normalise"] = "WITH " + GRID + """,
s AS (SELECT avg(ndvi) AS m, quantile_cont(ndvi, 0.025) AS plo, quantile_cont(ndvi, 0.975) AS phi FROM grid)
SELECT lat, lon, time, round((ndvi - m) / nullif(phi - plo, 0), 6) AS ndvi_pn FROM grid, s"""

ORACLES["unit_convert"] = "WITH " + MASKED + """
SELECT lat, lon, time, round((lst_day + lst_night) / 2, 6) AS lst_mean,
       round(precip / 30.417, 6) AS precip_mm_day, round(evi / 28.0, 6) AS evi_mm_day,
       round(sm / 10.0, 6) AS sm_rescaled
FROM mg"""

ORACLES["resample_median"] = """
SELECT user_id, date_trunc('month', date_trunc('day', ts)) AS time, round(median(value), 6) AS value
FROM events WHERE value IS NOT NULL GROUP BY 1, 2"""

ORACLES["resample_first"] = """
SELECT user_id, last_day(ts) AS time, arg_min(value, ts) FILTER (WHERE value IS NOT NULL) AS value
FROM events GROUP BY 1, 2"""

ORACLES["calendar_densify"] = "WITH " + GRID + """,
b AS (SELECT min(time) AS lo, max(time) AS hi FROM grid),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS TIMESTAMP) AS time FROM b),
px AS (SELECT DISTINCT lat, lon FROM grid)
SELECT px.lat, px.lon, cal.time, g.ndvi
FROM px CROSS JOIN cal
LEFT JOIN grid g ON g.lat = px.lat AND g.lon = px.lon AND g.time = cal.time"""

ORACLES["infer_freq"] = "WITH " + GRID + """,
d AS (SELECT date_trunc('day', ts) AS time FROM events)
SELECT 'grid' AS source, 'MS' AS freq, count(DISTINCT time) AS n_steps FROM grid
UNION ALL SELECT 'events_daily', 'D', count(DISTINCT time) FROM d
UNION ALL SELECT 'grid_month_end', 'M', count(DISTINCT time) FROM grid"""

AXES = GRID + """,
slat AS (SELECT DISTINCT lat AS v FROM grid),
slon AS (SELECT DISTINCT lon AS v FROM grid),
dlat AS (SELECT v + 0.125 AS d FROM slat),
dlon AS (SELECT v + 0.1 AS d FROM slon),
nlat AS (SELECT d, (SELECT max(v) FROM slat WHERE v <= d) AS a, (SELECT min(v) FROM slat WHERE v > d) AS a1 FROM dlat),
nlon AS (SELECT d, (SELECT max(v) FROM slon WHERE v <= d) AS a, (SELECT min(v) FROM slon WHERE v > d) AS a1 FROM dlon)"""

ORACLES["regrid_nearest"] = "WITH " + AXES + """,
mlat AS (SELECT d, CASE WHEN a IS NULL THEN a1 WHEN a1 IS NULL THEN a
                        WHEN d - a <= a1 - d THEN a ELSE a1 END AS s FROM nlat),
mlon AS (SELECT d, CASE WHEN a IS NULL THEN a1 WHEN a1 IS NULL THEN a
                        WHEN d - a <= a1 - d THEN a ELSE a1 END AS s FROM nlon)
SELECT round(mlat.d, 6) AS lat, round(mlon.d, 6) AS lon, g.time, g.ndvi, g.precip
FROM grid g JOIN mlat ON g.lat = mlat.s JOIN mlon ON g.lon = mlon.s"""

ORACLES["regrid_bilinear"] = "WITH " + AXES + """,
wl AS (
  SELECT d, a AS s, CASE WHEN d = a THEN 1.0 ELSE (a1 - d) / (a1 - a) END AS w FROM nlat
   WHERE a IS NOT NULL AND (d = a OR a1 IS NOT NULL)
  UNION ALL
  SELECT d, a1, 1.0 - CASE WHEN d = a THEN 1.0 ELSE (a1 - d) / (a1 - a) END FROM nlat
   WHERE a IS NOT NULL AND (d = a OR a1 IS NOT NULL) AND a1 IS NOT NULL),
wl2 AS (SELECT *, count(*) OVER (PARTITION BY d) AS nw FROM wl WHERE w <> 0),
wo AS (
  SELECT d, a AS s, CASE WHEN d = a THEN 1.0 ELSE (a1 - d) / (a1 - a) END AS w FROM nlon
   WHERE a IS NOT NULL AND (d = a OR a1 IS NOT NULL)
  UNION ALL
  SELECT d, a1, 1.0 - CASE WHEN d = a THEN 1.0 ELSE (a1 - d) / (a1 - a) END FROM nlon
   WHERE a IS NOT NULL AND (d = a OR a1 IS NOT NULL) AND a1 IS NOT NULL),
wo2 AS (SELECT *, count(*) OVER (PARTITION BY d) AS nw FROM wo WHERE w <> 0),
j AS (SELECT wl2.d AS lat, wo2.d AS lon, g.time, wl2.w * wo2.w AS w, wl2.nw * wo2.nw AS need, g.ndvi, g.sm
      FROM grid g JOIN wl2 ON g.lat = wl2.s JOIN wo2 ON g.lon = wo2.s),
agg AS (SELECT lat, lon, time, count(*) AS rows_, first(need) AS need,
               sum(w * ndvi) AS ndvi, count(ndvi) AS n_ndvi, sum(w * sm) AS sm, count(sm) AS n_sm
        FROM j GROUP BY lat, lon, time),
cells AS (SELECT dlat.d AS lat, dlon.d AS lon, time FROM dlat, dlon, (SELECT DISTINCT time FROM grid))
SELECT round(c.lat, 6) AS lat, round(c.lon, 6) AS lon, c.time,
       round(CASE WHEN rows_ = need AND n_ndvi = need THEN ndvi END, 6) AS ndvi,
       round(CASE WHEN rows_ = need AND n_sm = need THEN sm END, 6) AS sm
FROM cells c LEFT JOIN agg ON agg.lat = c.lat AND agg.lon = c.lon AND agg.time = c.time"""

ORACLES["merge_cubes"] = "WITH " + GRID + """,
a AS (SELECT lat, lon, time, lst_day, lst_night FROM grid WHERE time < TIMESTAMP '2000-01-01'),
b AS (SELECT lat, lon, time, precip, ndvi FROM grid WHERE time >= TIMESTAMP '1998-01-01')
SELECT coalesce(a.lat, b.lat) AS lat, coalesce(a.lon, b.lon) AS lon, coalesce(a.time, b.time) AS time,
       lst_day, lst_night, precip, ndvi,
       CASE WHEN lst_day IS NOT NULL AND precip IS NOT NULL AND ndvi IS NOT NULL THEN ndvi END AS ndvi_all_valid
FROM a FULL OUTER JOIN b ON a.lat = b.lat AND a.lon = b.lon AND a.time = b.time"""

ORACLES["bbox_slice"] = "WITH " + GRID + """,
ref AS (SELECT lat, lon FROM grid WHERE lat BETWEEN 0.25 AND 0.75 AND lon BETWEEN 1.0 AND 3.0),
b AS (SELECT min(lat) la0, max(lat) la1, min(lon) lo0, max(lon) lo1 FROM ref)
SELECT lat, lon, time, ndvi FROM grid, b
WHERE lat BETWEEN la0 AND la1 AND lon BETWEEN lo0 AND lo1"""

ORACLES["time_slice"] = "WITH " + GRID + """,
b AS (SELECT min(time) t0, max(time) + INTERVAL 1 MONTH AS t1 FROM grid
      WHERE time BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31')
SELECT lat, lon, time, precip FROM grid, b WHERE time BETWEEN t0 AND t1"""

ORACLES["drop_last_step"] = "WITH " + GRID + """
SELECT lat, lon, time, evi FROM grid WHERE time < (SELECT max(time) FROM grid)"""

ORACLES["isel_time"] = "WITH " + GRID + """,
b AS (SELECT min(time) AS t0 FROM grid)
SELECT lat, lon, time, ndvi FROM grid, b
WHERE (year(time) * 12 + month(time)) - (year(t0) * 12 + month(t0)) = 5"""

LAND = GRID + """,
t1 AS (SELECT min(time) + INTERVAL 1 MONTH AS t FROM grid),
at1 AS (SELECT lat, lon, bool_or(sm IS NOT NULL) AS has FROM grid, t1 WHERE grid.time = t1.t GROUP BY 1, 2),
px AS (SELECT DISTINCT lat, lon FROM grid),
land AS (SELECT px.lat, px.lon, coalesce(at1.has, false) AS land
         FROM px LEFT JOIN at1 ON px.lat = at1.lat AND px.lon = at1.lon)"""

ORACLES["land_mask"] = "WITH " + LAND + " SELECT lat, lon, land FROM land"
ORACLES["sea_pixels"] = "WITH " + LAND + " SELECT lat, lon FROM land WHERE NOT land"

ORACLES["reference_mask"] = "WITH " + GRID + """,
t0 AS (SELECT min(time) AS t FROM grid),
at0 AS (SELECT lat, lon, bool_or(sm IS NOT NULL) AS has FROM grid, t0 WHERE grid.time = t0.t GROUP BY 1, 2),
px AS (SELECT DISTINCT lat, lon FROM grid),
m AS (SELECT px.lat, px.lon, NOT coalesce(at0.has, false) AS masked
      FROM px LEFT JOIN at0 ON px.lat = at0.lat AND px.lon = at0.lon)
SELECT g.lat, g.lon, g.time, CASE WHEN m.masked = false THEN g.precip END AS precip
FROM grid g LEFT JOIN m ON g.lat = m.lat AND g.lon = m.lon"""

DROUGHT_IDX = GRID + """,
di AS (
  SELECT *,
    round((precip - avg(precip) OVER pm) / nullif(stddev_pop(precip) OVER pm, 0), 9) AS spi,
    round(((precip - lst_day) - avg(precip - lst_day) OVER pm)
          / nullif(stddev_pop(precip - lst_day) OVER pm, 0), 9) AS spei
  FROM grid WINDOW pm AS (PARTITION BY lat, lon, month(time)))"""

ORACLES["drought_masks"] = "WITH " + DROUGHT_IDX + """,
f AS (
  SELECT *,
    coalesce(ndvi < round(avg(ndvi) OVER (PARTITION BY lat, lon, month(time))
                          - stddev_pop(ndvi) OVER (PARTITION BY lat, lon, month(time)), 9), false) AS drought_ndvi_month,
    coalesce(ndvi < round(avg(ndvi) OVER (PARTITION BY lat, lon)
                          - stddev_pop(ndvi) OVER (PARTITION BY lat, lon), 9), false) AS drought_ndvi_series
  FROM di)
SELECT lat, lon, time, spi + 0.0 AS spi, spei + 0.0 AS spei,
       coalesce(spi < -1, false) AS drought_spi, coalesce(spei < -1, false) AS drought_spei,
       drought_ndvi_month, drought_ndvi_series, NOT drought_ndvi_month AS not_drought
FROM f"""

_LAG_VARS = GV
ORACLES["drought_lags"] = "WITH " + LAND + """,
flags AS (
  SELECT g.lat, g.lon, g.time,
         coalesce(l.land AND coalesce(g.ndvi < round(avg(g.ndvi) OVER (PARTITION BY g.lat, g.lon)
                  - stddev_pop(g.ndvi) OVER (PARTITION BY g.lat, g.lon), 9), false), false) AS in_drought
  FROM grid g LEFT JOIN land l ON g.lat = l.lat AND g.lon = l.lon),
tmax AS (SELECT max(time) AS t FROM grid),
ds0 AS (SELECT g.* FROM grid g, tmax WHERE g.time < tmax.t),
latax AS (SELECT lat, row_number() OVER (ORDER BY lat) AS r, row_number() OVER (ORDER BY lat DESC) AS rr
          FROM (SELECT DISTINCT lat FROM ds0)),
mirror AS (SELECT a.lat AS src, b.lat AS dst FROM latax a JOIN latax b ON a.r = b.rr),
fl AS (SELECT m.dst AS lat, d.lon, d.time, d.precip FROM ds0 d JOIN mirror m ON d.lat = m.src),
ds1 AS (SELECT d.lat, d.lon, d.time, d.lst_day, d.lst_night, f.precip, d.sm, d.ndvi, d.evi
        FROM ds0 d LEFT JOIN fl f ON d.lat = f.lat AND d.lon = f.lon AND d.time = f.time),
ds2 AS (SELECT d.lat, d.lon, d.time, """ + ", ".join(
    (f"CASE WHEN coalesce(l.land, false) AND d.{v} < 200 THEN d.{v} END AS {v}" if v.startswith("lst")
     else f"CASE WHEN coalesce(l.land, false) THEN d.{v} END AS {v}") for v in GV) + """
        FROM ds1 d LEFT JOIN land l ON d.lat = l.lat AND d.lon = l.lon),
t0 AS (SELECT min(time) AS t FROM ds2),
ix AS (SELECT d.*, (year(d.time) * 12 + month(d.time)) AS mi,
              (year(d.time) * 12 + month(d.time)) - (year(t0.t) * 12 + month(t0.t)) AS t_idx
       FROM ds2 d, t0)
SELECT x.lat, x.lon, x.time, """ + ",\n       ".join(
    f"x.{v} AS {v}_t0, " + ", ".join(f"p{k}.{v} AS {v}_t{k}" for k in (1, 2, 3)) for v in _LAG_VARS) + """,
       coalesce(f.in_drought, false) AS in_drought
FROM ix x
LEFT JOIN ix p1 ON p1.lat = x.lat AND p1.lon = x.lon AND p1.mi = x.mi - 1
LEFT JOIN ix p2 ON p2.lat = x.lat AND p2.lon = x.lon AND p2.mi = x.mi - 2
LEFT JOIN ix p3 ON p3.lat = x.lat AND p3.lon = x.lon AND p3.mi = x.mi - 3
LEFT JOIN flags f ON f.lat = x.lat AND f.lon = x.lon AND f.time = x.time
WHERE x.t_idx >= 4"""

ORACLES["shift"] = "WITH " + GRID + """
SELECT g.lat, g.lon, g.time, g.precip, p.precip AS precip_prev, n.precip AS precip_next
FROM grid g
LEFT JOIN grid p ON p.lat = g.lat AND p.lon = g.lon AND p.time = g.time - INTERVAL 1 MONTH
LEFT JOIN grid n ON n.lat = g.lat AND n.lon = g.lon AND n.time = g.time + INTERVAL 1 MONTH"""

ORACLES["flip_lat"] = "WITH " + GRID + """,
latax AS (SELECT lat, row_number() OVER (ORDER BY lat) AS r, row_number() OVER (ORDER BY lat DESC) AS rr
          FROM (SELECT DISTINCT lat FROM grid)),
mirror AS (SELECT a.lat AS src, b.lat AS dst FROM latax a JOIN latax b ON a.r = b.rr)
SELECT m.dst AS lat, g.lon, g.time, g.precip FROM grid g JOIN mirror m ON g.lat = m.src"""

ORACLES["band_unpivot"] = "WITH " + GRID + """,
tx AS (SELECT time, row_number() OVER (ORDER BY time) AS idx FROM (SELECT DISTINCT time FROM grid)),
px AS (SELECT DISTINCT lat, lon FROM grid)
SELECT px.lat, px.lon, tx.time, g.precip
FROM px CROSS JOIN tx LEFT JOIN grid g ON g.lat = px.lat AND g.lon = px.lon AND g.time = tx.time"""


# Fixed values, written out here so that a wrong label in the library shows.
_LANDCOVER = """
(0, 11, 'Post-flooding or irrigated croplands', 'irrigated croplands', 'cropland', 2),
(1, 14, 'Rainfed croplands', 'Rainfed croplands', 'cropland', 2),
(2, 20, 'Mosaic cropland (50-70%) / vegetation (grassland, shrubland, forest) (20-50%)', 'cropland/vegetation', 'cropland', 2),
(3, 30, 'Mosaic vegetation (grassland, shrubland, forest) (50-70%) / cropland (20-50%)', 'vegetation/cropland', 'cropland', 2),
(4, 40, 'Closed to open (>15%) broadleaved evergreen and/or semi-deciduous forest (>5m)', 'broad-leaved evergreen/semi-deciduous forest', 'forest', 3),
(5, 50, 'Closed (>40%) broadleaved deciduous forest (>5m)', 'broad-leaved deciduous forest', 'forest', 3),
(6, 60, 'Open (15-40%) broadleaved deciduous forest (>5m)', 'broad-leaved deciduous forest', 'forest', 3),
(7, 70, 'Closed (>40%) needleleaved evergreen forest (>5m)', 'needle-leaved evergreen forest', 'forest', 3),
(8, 90, 'Open (15-40%) needleleaved deciduous or evergreen forest (>5m)', 'needle-leaved deciduous / evergreen forest', 'forest', 3),
(9, 100, 'Closed to open (>15%) mixed broadleaved and needleleaved forest (>5m)', 'broad-leaved / needleleaved forest', 'forest', 3),
(10, 110, 'Mosaic forest-shrubland (50-70%) / grassland (20-50%)', 'forest-shrubland / grassland', 'shrubland/grassland', 4),
(11, 120, 'Mosaic grassland (50-70%) / forest-shrubland (20-50%)', 'Mosaic grassland / forest-shrubland', 'shrubland/grassland', 4),
(12, 130, 'Closed to open (>15%) shrubland (<5m)', 'shrubland', 'shrubland', 5),
(13, 140, 'Closed to open (>15%) grassland', 'grassland', 'grassland', 6),
(14, 150, 'Sparse (>15%) vegetation (woody vegetation, shrubs, grassland)', 'Sparse vegetation', 'Sparse vegetation', 7),
(15, 160, 'Closed (>40%) broadleaved forest regularly flooded - Fresh water', 'forest regularly flooded - Fresh water', 'flooded', 8),
(16, 170, 'Closed (>40%) broadleaved semi-deciduous and/or evergreen forest regularly flooded - saline water', 'forest regularly flooded - saline water', 'flooded', 8),
(17, 180, 'Closed to open (>15%) vegetation (grassland, shrubland, woody vegetation) on regularly flooded or waterlogged soil', 'vegetation on flooded soil', 'flooded', 8),
(18, 190, 'Artificial surfaces and associated areas (urban areas >50%) GLOBCOVER 2009', 'Artificial', 'Artificial', 9),
(19, 200, 'Bare areas', 'Bare areas', 'Bare areas', 10),
(20, 210, 'Water bodies', 'Water bodies', 'Water bodies', 11),
(21, 220, 'Permanent snow and ice', 'Permanent snow and ice', 'Permanent snow and ice', 12),
(22, 230, 'Unclassified', 'Unclassified', 'Unclassified', 13)"""


ORACLES["class_lookup"] = """
WITH dim(pos, code, label, short_label, class, class_id) AS (VALUES """ + _LANDCOVER + """)
SELECT p.p_partkey, dim.code, dim.label, dim.short_label, dim.class, dim.class_id
FROM part p LEFT JOIN dim ON dim.pos = p.p_size % 23"""


ORACLES["class_inversion"] = """
SELECT p_partkey, p_size % 15 AS class_id, CASE p_size % 15
  WHEN 2 THEN 'cropland' WHEN 3 THEN 'forest' WHEN 4 THEN 'shrubland/grassland' WHEN 5 THEN 'shrubland'
  WHEN 6 THEN 'grassland' WHEN 7 THEN 'Sparse vegetation' WHEN 8 THEN 'flooded' WHEN 9 THEN 'Artificial'
  WHEN 10 THEN 'Bare areas' WHEN 11 THEN 'Water bodies' WHEN 12 THEN 'Permanent snow and ice'
  WHEN 13 THEN 'Unclassified' END AS class FROM part"""

# Regions as edge lists (xi, yi, xj, yj); the second triangle of north is a hole.
ORACLES["clip_polygon"] = "WITH " + GRID + """,
edge(country, xi, yi, xj, yj) AS (VALUES
  ('north', 0.1, -0.1, 0.1, 1.1), ('north', 8.0, 0.4, 0.1, -0.1), ('north', 0.1, 1.1, 8.0, 0.4),
  ('north', 0.6, 0.2, 0.6, 0.7), ('north', 2.2, 0.4, 0.6, 0.2), ('north', 0.6, 0.7, 2.2, 0.4),
  ('south', 3.0, 0.3, 5.0, 0.9), ('south', 9.9, -0.2, 3.0, 0.3), ('south', 9.9, 1.2, 9.9, -0.2), ('south', 5.0, 0.9, 9.9, 1.2)),
e AS (SELECT country, xi::DOUBLE AS xi, yi::DOUBLE AS yi, xj::DOUBLE AS xj, yj::DOUBLE AS yj FROM edge),
px AS (SELECT DISTINCT lat, lon FROM grid)
SELECT lat, lon, country FROM px, e
WHERE (yi > lat) <> (yj > lat) AND lon < (xj - xi) * (lat - yi) / (yj - yi) + xi
GROUP BY lat, lon, country HAVING count(*) % 2 = 1"""

VERIF = GRID + """,
pred AS (SELECT g.lat, g.lon, g.time, p.ndvi AS prediction FROM grid g JOIN grid p
         ON p.lat = g.lat AND p.lon = g.lon AND p.time = g.time - INTERVAL 1 MONTH WHERE p.ndvi IS NOT NULL),
vf AS (SELECT pred.lat, pred.lon, pred.time, pred.prediction, g.ndvi AS y FROM pred JOIN grid g
       ON g.lat = pred.lat AND g.lon = pred.lon AND g.time = pred.time WHERE g.ndvi IS NOT NULL)"""

MET = """count(*) AS n,
       round(sqrt(avg((y - prediction) * (y - prediction))), 6) AS rmse,
       round(sum(abs(y - prediction)), 6) / count(*) AS mae,
       round(1 - var_pop(y - prediction) / nullif(var_pop(y), 0), 6) AS explained_variance,
       round(1 - sum((y - prediction) * (y - prediction)) / nullif(var_pop(y) * count(*), 0), 6) AS r2,
       round((round(sum(prediction), 6) / count(*) - round(sum(y), 6) / count(*)) / nullif(round(sum(y), 6) / count(*), 0) * 100, 6) AS pct_bias"""

ORACLES["verification"] = "WITH " + VERIF + " SELECT " + MET + " FROM vf"

ORACLES["band_metrics"] = "WITH " + VERIF + """,
q AS (SELECT quantile_cont(y, 0.2) q20, quantile_cont(y, 0.4) q40, quantile_cont(y, 0.6) q60,
             quantile_cont(y, 0.8) q80 FROM vf),
b AS (SELECT vf.*, CASE WHEN y < q20 THEN 'low' WHEN y > q80 THEN 'high'
                        WHEN y > q40 AND y < q60 THEN 'mid' END AS band FROM vf, q)
SELECT band, """ + MET + " FROM b WHERE band IS NOT NULL GROUP BY band"

ORACLES["error_mask"] = "WITH " + VERIF + """,
e AS (SELECT *, y - prediction AS difference FROM vf),
t AS (SELECT quantile_cont(abs(difference), 0.9) AS thr FROM e)
SELECT lat, lon, time, round(difference, 6) AS difference FROM e, t WHERE abs(difference) > thr"""


DAILY = """
dp AS (
  SELECT CAST(o_custkey % 6 AS DOUBLE) * 2e-1 AS lat,
         CAST((o_custkey // 6) % (SELECT max(s_suppkey) // 2 + 3 FROM supplier) AS DOUBLE) * 2e-1 AS lon,
         o_orderdate AS time, round(sum(o_totalprice), 2) / 1e3 AS value, CAST(count(*) AS DOUBLE) AS orders
  FROM orders GROUP BY 1, 2, 3)"""


def _neighbours(tag: str) -> str:
    """Axis CTEs from the daily product onto the grid's axes."""
    return f"""
s{tag}lat AS (SELECT DISTINCT lat AS v FROM dp),
s{tag}lon AS (SELECT DISTINCT lon AS v FROM dp),
d{tag}lat AS (SELECT DISTINCT lat AS d FROM grid),
d{tag}lon AS (SELECT DISTINCT lon AS d FROM grid),
n{tag}lat AS (SELECT d, (SELECT max(v) FROM s{tag}lat WHERE v <= d) AS a,
                        (SELECT min(v) FROM s{tag}lat WHERE v > d) AS a1 FROM d{tag}lat),
n{tag}lon AS (SELECT d, (SELECT max(v) FROM s{tag}lon WHERE v <= d) AS a,
                        (SELECT min(v) FROM s{tag}lon WHERE v > d) AS a1 FROM d{tag}lon)"""


def _bilinear(src: str, tag: str, var: str, out: str, times: str) -> str:
    """Every grid cell at every step of ``times``; NULL where a corner is missing."""
    w = []
    for ax in ("lat", "lon"):
        n = f"n{tag}{ax}"
        w0 = "CASE WHEN d = a THEN 1.0 ELSE (a1 - d) / (a1 - a) END"
        w.append(f"""
w{tag}{ax}0 AS (
  SELECT d, a AS s, {w0} AS w FROM {n} WHERE a IS NOT NULL AND (d = a OR a1 IS NOT NULL)
  UNION ALL
  SELECT d, a1, 1.0 - {w0} FROM {n} WHERE a IS NOT NULL AND (d = a OR a1 IS NOT NULL) AND a1 IS NOT NULL),
w{tag}{ax} AS (SELECT *, count(*) OVER (PARTITION BY d) AS nw FROM w{tag}{ax}0 WHERE w <> 0)""")
    return _neighbours(tag) + "," + ",".join(w) + f""",
j{tag} AS (SELECT wl.d AS lat, wo.d AS lon, x.time, wl.w * wo.w AS w, wl.nw * wo.nw AS need, x.{var} AS v
          FROM {src} x JOIN w{tag}lat wl ON x.lat = wl.s JOIN w{tag}lon wo ON x.lon = wo.s),
v{tag} AS (SELECT lat, lon, time,
                 CASE WHEN count(*) = first(need) AND count(v) = first(need) THEN sum(w * v) END AS {var}
          FROM j{tag} GROUP BY lat, lon, time),
{out} AS (SELECT c.lat, c.lon, c.time, v.{var}
          FROM (SELECT y.d AS lat, x.d AS lon, time FROM d{tag}lat y, d{tag}lon x, ({times})) c
          LEFT JOIN v{tag} v ON v.lat = c.lat AND v.lon = c.lon AND v.time = c.time)"""


def _nearest(src: str, tag: str, columns: str, out: str) -> str:
    pick = "CASE WHEN a IS NULL THEN a1 WHEN a1 IS NULL THEN a WHEN d - a <= a1 - d THEN a ELSE a1 END"
    return _neighbours(tag) + f""",
m{tag}lat AS (SELECT d, {pick} AS s FROM n{tag}lat),
m{tag}lon AS (SELECT d, {pick} AS s FROM n{tag}lon),
{out} AS (SELECT ml.d AS lat, mo.d AS lon, x.time, {columns}
          FROM {src} x JOIN m{tag}lat ml ON x.lat = ml.s JOIN m{tag}lon mo ON x.lon = mo.s)"""


ORACLES["harmonise_script"] = "WITH " + GRID + "," + DAILY + """,
fm AS (SELECT lat, lon, last_day(time) AS time, arg_min(value, time) FILTER (WHERE value IS NOT NULL) AS value,
              arg_min(orders, time) FILTER (WHERE orders IS NOT NULL) AS orders
       FROM dp GROUP BY 1, 2, 3),
sl AS (SELECT * FROM fm WHERE time BETWEEN TIMESTAMP '1995-02-14' AND TIMESTAMP '2001-09-01'),""" + \
    _nearest("sl", "h", "x.value, x.orders", "p") + """,
r AS (SELECT lat, lon, last_day(time) AS time, precip, ndvi FROM grid
      WHERE time BETWEEN TIMESTAMP '1995-02-14' AND TIMESTAMP '2001-09-01'),
l AS (SELECT lat, lon, last_day(time) AS time, lst_day, lst_night FROM grid
      WHERE last_day(time) BETWEEN TIMESTAMP '1995-02-14' AND TIMESTAMP '2001-09-01'),
k AS (SELECT lat, lon, time FROM r UNION SELECT lat, lon, time FROM l UNION SELECT lat, lon, time FROM p)
SELECT k.lat, k.lon, k.time, r.precip, r.ndvi, p.value, p.orders, l.lst_day, l.lst_night
FROM k LEFT JOIN r USING (lat, lon, time) LEFT JOIN p USING (lat, lon, time) LEFT JOIN l USING (lat, lon, time)"""

ORACLES["relabel_calendar"] = "WITH " + GRID + "," + DAILY + """,
fm AS (SELECT lat, lon, last_day(time) AS t, arg_min(value, time) FILTER (WHERE value IS NOT NULL) AS value FROM dp GROUP BY 1, 2, 3),
ax AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i FROM (SELECT DISTINCT t FROM fm)),
t0 AS (SELECT min(date_trunc('month', time)) AS t0 FROM grid)
SELECT fm.lat, fm.lon, CAST(t0.t0 + to_months(CAST(ax.i AS INTEGER)) AS TIMESTAMP) AS time, fm.value FROM fm JOIN ax USING (t), t0"""

_MONTHS = "SELECT DISTINCT md.time FROM md, b WHERE md.time BETWEEN b.t0 AND b.t1"
ORACLES["harmonise_bilinear"] = "WITH " + DROUGHT_IDX + "," + DAILY + """,
md AS (SELECT lat, lon, date_trunc('month', time) AS time, median(value) AS evap, median(orders) AS pet FROM dp GROUP BY 1, 2, 3),
rf AS (SELECT * FROM di WHERE time BETWEEN (SELECT min(time) FROM md) AND (SELECT max(time) FROM md)),
b AS (SELECT min(time) AS t0, max(time) + INTERVAL 1 MONTH AS t1 FROM rf),
sl AS (SELECT md.* FROM md, b WHERE md.time BETWEEN b.t0 AND b.t1),""" + \
    _bilinear("sl", "b", "evap", "p", _MONTHS) + "," + _bilinear("sl", "c", "pet", "o", _MONTHS) + """,
k AS (SELECT lat, lon, time FROM rf UNION SELECT lat, lon, time FROM p UNION SELECT lat, lon, time FROM o),
m AS (SELECT k.lat, k.lon, k.time, rf.ndvi, rf.lst_day, rf.lst_night, rf.spi, rf.spei, p.evap, o.pet
      FROM k LEFT JOIN rf USING (lat, lon, time) LEFT JOIN p USING (lat, lon, time) LEFT JOIN o USING (lat, lon, time))
SELECT lat, lon, time, ndvi, round((lst_day + lst_night) / 2, 6) AS lst_mean,
       floor(floor(evap * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS evap, floor(floor(pet * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS pet,
       coalesce(spei < -1, false) AS drought_spei, coalesce(spi < -1, false) AS drought_spi,
       coalesce(ndvi < round(avg(ndvi) OVER (PARTITION BY lat, lon, month(time))
                             - stddev_pop(ndvi) OVER (PARTITION BY lat, lon, month(time)), 9), false) AS drought_ndvi
FROM m"""

# Both calendars cut to the months that grid and product share.
_FIRST = "WITH " + GRID + "," + DAILY + """,
fm AS (SELECT lat, lon, CAST(date_trunc('month', time) AS TIMESTAMP) AS time,
              arg_min(value, time) FILTER (WHERE value IS NOT NULL) AS value FROM dp GROUP BY 1, 2, 3),
b AS (SELECT min(time) AS t0, max(time) AS t1 FROM grid
      WHERE time BETWEEN (SELECT min(time) FROM fm) AND (SELECT max(time) FROM fm)),
t0 AS (SELECT min(time) AS t FROM grid),
at0 AS (SELECT lat, lon, bool_or(sm IS NOT NULL) AS has FROM grid, t0 WHERE grid.time = t0.t GROUP BY 1, 2),
px AS (SELECT DISTINCT lat, lon FROM grid),
m AS (SELECT px.lat, px.lon, NOT coalesce(at0.has, false) AS masked
      FROM px LEFT JOIN at0 ON px.lat = at0.lat AND px.lon = at0.lon),"""

ORACLES["harmonise_rainfall"] = _FIRST + """
sl0 AS (SELECT fm.lat, fm.lon, fm.time, fm.value / 30.417 AS value FROM fm, b WHERE fm.time BETWEEN b.t0 AND b.t1),""" + \
    _bilinear("sl0", "r", "value", "p", "SELECT DISTINCT grid.time FROM grid, b WHERE grid.time BETWEEN b.t0 AND b.t1") + """
SELECT p.lat, p.lon, p.time, round(CASE WHEN m.masked = false THEN p.value END, 6) AS precip
FROM p LEFT JOIN m ON p.lat = m.lat AND p.lon = m.lon"""

ORACLES["harmonise_evaporation"] = _FIRST + """
sl0 AS (SELECT fm.lat, fm.lon, fm.time, fm.value / 28.0 AS value FROM fm, b WHERE fm.time BETWEEN b.t0 AND b.t1),""" + \
    _nearest("sl0", "e", "x.value", "p") + """
SELECT p.lat, p.lon, p.time,
       floor(floor(CASE WHEN m.masked = false THEN p.value END * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS evaporation
FROM p LEFT JOIN m ON p.lat = m.lat AND p.lon = m.lon"""

ORACLES["reference_cleaner"] = "WITH " + DAILY + """,
f AS (SELECT lat, lon + 30.0::DOUBLE AS lon, last_day(time) AS time, arg_min(value / 28.0, time) FILTER (WHERE value IS NOT NULL) AS v
      FROM dp WHERE lat BETWEEN -5.0 AND 15.2 AND lon + 30.0::DOUBLE BETWEEN 32.6 AND 51.8 GROUP BY 1, 2, 3)
SELECT lat, lon, time, floor(floor(v * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS holaps_evapotranspiration FROM f"""




def _reprojected(x0: float, y0: float, step: float, ctes: str, res: float) -> str:
    """Sixteen points per pixel (``px, py``, metres), their places (``ctes`` end in ``place`` with ``lat, lon``
    in degrees), and the mean per cell of side ``res``."""
    return f"""
pix AS (SELECT DISTINCT round(lon / 0.2) * {step}::DOUBLE + {x0}::DOUBLE AS x, round(lat / 0.2) * {step}::DOUBLE + {y0}::DOUBLE AS y FROM dp),
pt AS (SELECT x, y, x + ((a + 0.5) / 4 - 0.5) * {step}::DOUBLE AS px, y + ((b + 0.5) / 4 - 0.5) * {step}::DOUBLE AS py
       FROM (SELECT x, y, a::DOUBLE AS a, unnest(range(0, 4))::DOUBLE AS b FROM (SELECT x, y, unnest(range(0, 4)) AS a FROM pix))),
{ctes},
w AS (SELECT x, y, (floor(lat / {res}::DOUBLE) + 0.5) * {res}::DOUBLE AS lat, (floor(lon / {res}::DOUBLE) + 0.5) * {res}::DOUBLE AS lon, count(*) AS w FROM place GROUP BY ALL),
cell AS (
  SELECT w.lat, w.lon, dp.time, round(sum(dp.value * w), 5) / sum(w) AS value
  FROM dp JOIN w ON round(dp.lon / 0.2) * {step}::DOUBLE + {x0}::DOUBLE = w.x AND round(dp.lat / 0.2) * {step}::DOUBLE + {y0}::DOUBLE = w.y GROUP BY ALL)"""


ORACLES["reference_cleaner_sinusoidal"] = "WITH " + DAILY + "," + _reprojected(3611000.0, -187000.0, 23000.0, """
place AS (
  SELECT x, y, degrees(la) AS lat, degrees(lo) AS lon FROM (
    SELECT x, y, py / 6371007.181::DOUBLE AS la, px / (6371007.181::DOUBLE * cos(py / 6371007.181::DOUBLE)) AS lo FROM pt)
  WHERE abs(la) < pi() / 2 AND abs(lo) <= pi())""", 0.25) + """,
f AS (SELECT lat, lon, last_day(time) AS time, arg_min(value / 28.0, time) FILTER (WHERE value IS NOT NULL) AS v
      FROM cell WHERE lat BETWEEN -5.0 AND 15.2 AND lon BETWEEN 32.6 AND 51.8 GROUP BY 1, 2, 3)
SELECT lat, lon, time, floor(floor(v * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS holaps_evapotranspiration FROM f"""

ORACLES["reproject_geostationary"] = "WITH " + DAILY + "," + _reprojected(2010000.0, 4503000.0, 151000.0, """
ang AS (SELECT x, y, px / 35785831.0::DOUBLE AS a, py / 35785831.0::DOUBLE AS b, power(6378169.0::DOUBLE / 6356583.8::DOUBLE, 2) AS q FROM pt),
ray AS (SELECT *, cos(b) * cos(b) + q * sin(b) * sin(b) AS bulge, 42164000.0::DOUBLE * cos(a) * cos(b) AS ahead FROM ang),
hit AS (SELECT *, ahead * ahead - bulge * (power(42164000.0::DOUBLE, 2) - power(6378169.0::DOUBLE, 2)) AS inside FROM ray),
far AS (SELECT *, (ahead - sqrt(inside)) / bulge AS d FROM hit WHERE inside >= 0),
place AS (
  SELECT x, y, degrees(atan(q * d * sin(b) / sqrt(power(42164000.0 - d * cos(a) * cos(b), 2) + power(d * sin(a) * cos(b), 2)))) AS lat,
         degrees(atan(d * sin(a) * cos(b) / (42164000.0 - d * cos(a) * cos(b)))) + 9.5 AS lon FROM far)""", 1.5) + """
SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, time, floor(floor(value * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS value FROM cell"""


ORACLES["pixel_year_counts"] = "WITH " + CLEAN + """,
n AS (SELECT lat, lon, gb_year, count(*) AS n FROM cleaned GROUP BY 1, 2, 3)
SELECT gb_year, CAST(count_if(n = 12) AS BIGINT) AS processed, CAST(count_if(n <> 12) AS BIGINT) AS skipped
FROM n GROUP BY gb_year"""

ORACLES["min_max"] = "WITH " + MASKED + " SELECT " + ", ".join(
    f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in GV) + " FROM mg"

ORACLES["lst_mask_by_mean"] = "WITH " + GRID + """
SELECT lat, lon, time,
       CASE WHEN (lst_day + lst_night) / 2 < 100 THEN lst_day END AS lst_day,
       CASE WHEN (lst_day + lst_night) / 2 < 100 THEN lst_night END AS lst_night
FROM grid"""

ORACLES["labelled_stack"] = "WITH " + VERIF + """
SELECT g.lat, g.lon, g.time, p.ndvi, 'prediction' AS data FROM grid g JOIN grid p
  ON p.lat = g.lat AND p.lon = g.lon AND p.time = g.time - INTERVAL 1 MONTH WHERE p.ndvi IS NOT NULL
UNION ALL
SELECT lat, lon, time, ndvi, 'truth' FROM grid WHERE ndvi IS NOT NULL"""

ORACLES["first_rows"] = "WITH " + GRID + " SELECT * FROM grid ORDER BY time, lat, lon LIMIT 10"

ORACLES["month_names"] = "WITH " + GRID + """,
m AS (SELECT lat, lon, month(time) AS month, avg(ndvi) AS m FROM grid GROUP BY 1, 2, 3)
SELECT CAST(month AS INTEGER) AS month, monthname(make_date(2000, month, 1)) AS month_name,
       round(max(m), 6) AS ndvi_max_monthly_mean FROM m GROUP BY month"""

ORACLES["smooth_l1"] = "WITH " + VERIF + """,
e AS (SELECT year(time) AS year, abs(y - prediction) AS e FROM vf),
s AS (SELECT year, count(*) AS n,
             round(sum(CASE WHEN e < 1 THEN 0.5 * e * e ELSE e - 0.5 END), 7) / count(*) AS l FROM e GROUP BY year)
SELECT CAST(year AS INTEGER) AS year, n, floor(floor(l * 1e10 + 0.5) / 1e4 + 0.5) / 1e6 AS smooth_l1 FROM s"""


# Round trips read back exactly what the Spark side wrote; the oracles are
# the same computations straight from the source tables.
ORACLES["round_trip_csv"] = ORACLES["cube_clean"]
ORACLES["round_trip_json"] = ORACLES["normalising_stats"]

ORACLES["guarded_write"] = "WITH " + GRID + """
SELECT lat, lon, time, precip, round(ndvi, 6) AS ndvi, 'kept' AS write FROM grid
UNION ALL SELECT lat, lon, time, precip, round(ndvi + 1, 6), 'forced' FROM grid"""

ORACLES["cube_round_trip"] = "WITH " + GRID + " SELECT lat, lon, time, " + ", ".join(GV) + " FROM grid"

ORACLES["cube_blocks_box"] = "WITH " + GRID + " SELECT lat, lon, time, " + ", ".join(GV) + """ FROM grid
WHERE lat BETWEEN 0.25 AND 0.75 AND lon BETWEEN 1.0 AND 3.0 AND time BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1999-06-01'"""
ORACLES["tiles_round_trip"] = "WITH " + GRID + " SELECT lat, lon, time, sm FROM grid WHERE sm IS NOT NULL"
ORACLES["tile_slice"] = "WITH " + GRID + """,
placed AS (SELECT lat, lon, time, precip, dense_rank() OVER (ORDER BY lat) - 1 AS i, dense_rank() OVER (ORDER BY lon) - 1 AS j,
              dense_rank() OVER (ORDER BY time) - 1 AS k FROM grid)
SELECT lat, lon, time, precip FROM placed WHERE i BETWEEN 1 AND 3 AND j BETWEEN 2 AND 8 AND k BETWEEN 10 AND 29 AND precip IS NOT NULL"""
ORACLES["nan_ingest"] = "WITH " + GRID + """,
m AS (SELECT lat, lon, round(sum(sm), 6) / count(sm) AS sm FROM grid GROUP BY lat, lon)
SELECT *, 'parquet' AS format FROM m UNION ALL SELECT *, 'csv' FROM m"""

ORACLES["parse_time"] = "WITH " + GRID + " SELECT lat, lon, time, time AS time_named FROM grid"

ORACLES["fixed_box"] = "WITH " + GRID + """
SELECT lat, lon + 30.0::DOUBLE AS lon, time, ndvi FROM grid
WHERE lat BETWEEN -5.0 AND 15.2 AND lon + 30.0::DOUBLE BETWEEN 32.6 AND 51.8"""

ORACLES["isel_axes"] = "WITH " + GRID + """
SELECT lat, lon, time, ndvi FROM grid
WHERE lat = (SELECT DISTINCT lat FROM grid ORDER BY lat LIMIT 1 OFFSET 1) AND lon = (SELECT max(lon) FROM grid)"""

ORACLES["mask_to_boolean"] = "WITH " + GRID + """
SELECT lat, lon, time, CAST(floor(sm * 1000) % 2 AS BOOLEAN) AS m FROM grid"""

ORACLES["denormalise"] = "WITH " + CLEAN + " SELECT lat, lon, time, variable, round(v, 6) AS value_raw FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT lat, lon, time, '{c}' AS variable, {c} AS v FROM cleaned" for c in VALUE_COLS) + ") WHERE v IS NOT NULL"

ORACLES["verification_gaps"] = "WITH " + GRID + """,
vf AS (SELECT g.sm AS y, p.sm AS prediction FROM grid g JOIN grid p
       ON p.lat = g.lat AND p.lon = g.lon AND p.time = g.time - INTERVAL 1 MONTH
       WHERE g.sm IS NOT NULL AND p.sm IS NOT NULL)
SELECT """ + MET + " FROM vf"

# Inputs of an example in step-major order: j = 7 * (step - 1) + variable.
INPUTS = EXAMPLES + """,
long AS (""" + "\nUNION ALL\n".join(
    f"SELECT lat, lon, gb_year, split, y, step, 7 * (step - 1) + {k} AS j, {c} AS v FROM steps" for k, c in enumerate(VALUE_COLS)) + """),
ex AS (SELECT lat, lon, gb_year, split, y, list(v ORDER BY j) AS x FROM long GROUP BY lat, lon, gb_year, split, y)"""

ORACLES["examples_round_trip"] = "WITH " + INPUTS + """
SELECT lat, lon, gb_year, split, y, CAST(j AS INTEGER) AS j, round(v, 6) AS v FROM long WHERE split = 'test'"""

_FIT = "SELECT split, count(*) AS n, CASE WHEN split = 'train' THEN 0.0::DOUBLE END AS normal_residual"
ORACLES["linear_fit_score"] = "WITH " + EXAMPLES + _FIT.join(("\n", "")) + " FROM steps WHERE step = 1 GROUP BY split"


def _least_squares(tag: str, inputs: str) -> str:
    """``fit_{tag}(b)``: intercept and coefficients by Gauss-Jordan elimination of the normal equations
    (one elimination per recursive step), and ``in_{tag}`` with the chosen inputs behind a 1."""
    return f"""
in_{tag} AS (SELECT split, y, list_prepend(1.0::DOUBLE, {inputs}) AS a FROM ex),
cell_{tag} AS (
  SELECT i, j, sum(a[i] * c[j]) AS s
  FROM (SELECT a, c, i, unnest(range(1, len(c) + 1)) AS j FROM (
    SELECT a, list_append(a, y) AS c, unnest(range(1, len(a) + 1)) AS i FROM in_{tag} WHERE split = 'train')) GROUP BY i, j),
solve_{tag}(k, m) AS (
  SELECT 0::BIGINT, list(row ORDER BY i) FROM (SELECT i, list(s ORDER BY j) AS row FROM cell_{tag} GROUP BY i)
  UNION ALL
  SELECT k + 1, [CASE WHEN i = k + 1 THEN [v / m[k + 1][k + 1] for v in m[k + 1]]
                      ELSE [m[i][j] - m[i][k + 1] / m[k + 1][k + 1] * m[k + 1][j] for j in range(1, len(m) + 2)] END for i in range(1, len(m) + 1)]
  FROM solve_{tag} WHERE k < len(m)),
fit_{tag} AS (SELECT [r[len(m) + 1] for r in m] AS b FROM solve_{tag} WHERE k = len(m))"""


_VARIANTS = {"all_features": "x", "no_vegetation": "[x[j] for j in range(1, 78) if (j - 1) % 7 < 4]"}
ORACLES["ablation"] = "WITH RECURSIVE " + INPUTS + "," + ",".join(_least_squares(t, x) for t, x in _VARIANTS.items()) + "\nUNION ALL".join(f"""
SELECT split, count(*) AS n, CASE WHEN split = 'train' THEN 0.0::DOUBLE END AS normal_residual, '{t}' AS variant,
       round(sqrt(avg(power(y - list_inner_product(a, (SELECT b FROM fit_{t})), 2))), 6) AS rmse FROM in_{t} GROUP BY split""" for t in _VARIANTS)
ORACLES["nonlinear_fit_score"] = "WITH " + EXAMPLES + """
SELECT split, count(*) AS n, CASE WHEN split = 'train' THEN true END AS beats_mean FROM steps WHERE step = 1 GROUP BY split"""
ORACLES["linear_attribution"] = "WITH " + EXAMPLES + """
SELECT lat, lon, gb_year, 77::BIGINT AS n, 0.0::DOUBLE AS residual FROM steps WHERE step = 1 AND split = 'test'"""
for _name in ("tree_attribution", "network_attribution"):
    ORACLES[_name] = ORACLES["linear_attribution"]
ORACLES["early_stop"] = "WITH " + EXAMPLES + """
SELECT split, count(*) AS n, CASE WHEN split = 'train' THEN true END AS beats_mean, true AS best_is_least, true AS waited FROM steps WHERE step = 1 GROUP BY split"""
ORACLES["network_fit_score"] = "WITH " + EXAMPLES + """
SELECT split, count(*) AS n, CASE WHEN split = 'train' THEN true END AS beats_mean, true AS learned FROM steps WHERE step = 1 GROUP BY split"""
ORACLES["model_round_trip"] = "WITH " + EXAMPLES + """
SELECT lat, lon, gb_year, split, y, 0.0::DOUBLE AS difference FROM steps WHERE step = 1"""
_LABEL = "['lst_night', 'lst_day', 'precip', 'sm', 'ndvi', 'evi', 'ndvi_anomaly'][j % 7 + 1] || '_' || (j // 7 + 1)"
ORACLES["coef_top10"] = "WITH RECURSIVE " + INPUTS + "," + _least_squares("all_features", "x") + f""",
c AS (SELECT unnest(range(0, 77)) AS j, unnest(b[2:]) AS value FROM fit_all_features)
SELECT {_LABEL} AS feature, round(value, 4) AS value FROM c ORDER BY abs(value) DESC, feature LIMIT 10"""
ORACLES["mean_input_top10"] = "WITH " + INPUTS + f""",
m AS (SELECT {_LABEL} AS feature, round(avg(v), 6) AS value FROM long WHERE split = 'train' GROUP BY j)
SELECT feature, value FROM m ORDER BY abs(value) DESC, feature LIMIT 10"""


def _rule(rows: str, cols: str, a: int, b: int) -> str:
    """The weight at 0-based (row, column) of the closed-form set."""
    return f"((({rows}) * {a} + ({cols}) * {b}) % 11 - 5) / 50.0::DOUBLE"


def _ffn_sql() -> str:
    dense = f"[list_sum([x[j + 1] * {_rule('i', 'j', 7, 3)} for j in range(0, 77)]) / sqrt(1.0::DOUBLE + 1e-5::DOUBLE) for i in range(0, 77)]"
    return "WITH " + INPUTS + f""",
h AS (SELECT lat, lon, gb_year, y, {dense} AS h FROM ex)
SELECT lat, lon, gb_year, y,
       round(list_sum([CASE WHEN h[j + 1] > 0 THEN h[j + 1] ELSE 0.1 * h[j + 1] END * {_rule('0', 'j', 1, 5)} for j in range(0, 77)]) + 0.25, 6) AS prediction
FROM h"""


def _rnn_sql(hidden: int = 3, n: int = 7) -> str:
    """Eleven steps of the gated cell, then the two dense layers; one CTE per step."""
    ctes = ["r0 AS (SELECT lat, lon, gb_year, y, x, " + ", ".join(f"0.0::DOUBLE AS h{i}, 0.0::DOUBLE AS c{i}" for i in range(hidden)) + " FROM ex)"]
    for t in range(11):
        z = [f"x[{t * n + k + 1}]" for k in range(n)] + [f"h{i}" for i in range(hidden)]

        def gate(k: int, i: int, z: list[str] = z) -> str:
            return "(" + " + ".join(f"{v} * ({(i * (k + 2) + j * (k + 3)) % 11 - 5} / 50.0::DOUBLE)" for j, v in enumerate(z)) + f" + {0.1 * (k + 1):.1f}::DOUBLE)"

        cell = [f"(1 / (1 + exp(-{gate(0, i)}))) * c{i} + (1 / (1 + exp(-{gate(1, i)}))) * ((exp(2 * {gate(2, i)}) - 1) / (exp(2 * {gate(2, i)}) + 1)) AS d{i}" for i in range(hidden)]
        out = [f"1 / (1 + exp(-{gate(3, i)})) AS o{i}" for i in range(hidden)]
        ctes.append(f"q{t} AS (SELECT lat, lon, gb_year, y, x, {', '.join(cell + out)} FROM r{t})")
        ctes.append(f"r{t + 1} AS (SELECT lat, lon, gb_year, y, x, " + ", ".join(
            f"o{i} * ((exp(2 * d{i}) - 1) / (exp(2 * d{i}) + 1)) AS h{i}, d{i} AS c{i}" for i in range(hidden)) + f" FROM q{t})")
    first = ["(" + " + ".join(f"h{j} * ({(i * 3 + j * 4) % 11 - 5} / 50.0::DOUBLE)" for j in range(hidden)) + f" + {0.1 * (i + 1):.1f}::DOUBLE)" for i in range(2)]
    last = " + ".join(f"{v} * ({(j * 2) % 11 - 5} / 50.0::DOUBLE)" for j, v in enumerate(first)) + " + 0.3::DOUBLE"
    return "WITH " + INPUTS + ",\n" + ",\n".join(ctes) + f"\nSELECT lat, lon, gb_year, y, round({last}, 6) AS prediction FROM r11"


ORACLES["ffn_score"] = _ffn_sql()
ORACLES["rnn_score"] = _rnn_sql()

# All months, the open one included.
ORACLES["stream_monthly_first"] = "WITH " + DAILY + """
SELECT lat, lon, CAST(date_trunc('month', time) AS TIMESTAMP) AS time,
       arg_min(value, time) FILTER (WHERE value IS NOT NULL) AS value, count(value) AS n_obs
FROM dp GROUP BY 1, 2, 3"""


def _positive_zero(sql: str) -> str:
    """Wrap every ``round(x, 6)`` as ``(round(x, 6) + 0.0)``: DuckDB returns
    -0.0 for tiny negatives, Spark returns 0.0."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _positive_zero(sql[j + 6:k])
        call = f"round({inner})"
        out.append(sql[i:j])
        out.append(f"({call} + 0.0)" if inner.replace(" ", "").endswith(",6") else call)
        i = k + 1


def oracles() -> dict:
    return {k: _positive_zero(v) for k, v in ORACLES.items()}
