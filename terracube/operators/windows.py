"""Window, lag and sequence operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.schema import PIXEL_ID, pixel_keys

EXAMPLE_KEYS = ["lat", "lon", "gb_year"]


def example_steps(df: DataFrame, features: Sequence[str], target: str = "target",
                  months: int = 12) -> DataFrame:
    """W8 + A5 in long form: one row per (pixel-year, input month).

    Keeps pixel-years with exactly ``months`` rows (the count rule, not
    distinct months), orders them by ``gb_month`` (T1); the first ``months-1``
    rows are the inputs (``step`` 1..11), the last row's ``target`` is
    ``y``.  One hash exchange on (lat, lon, gb_year) feeds both the count
    and the ordered frame; nothing is collected, so a pixel-year of any
    size streams through the sort.
    """
    keys = [PIXEL_ID, *EXAMPLE_KEYS] if PIXEL_ID in df.columns else EXAMPLE_KEYS
    part = Window.partitionBy(*keys)
    ordered = part.orderBy("gb_month", "time")
    df = df.withColumns({
        "n_rows": F.count(F.lit(1)).over(part),
        "step": F.row_number().over(ordered),
    }).where(F.col("n_rows") == months)
    df = df.withColumn("y", F.max(F.when(F.col("step") == months, F.col(target))).over(part))
    return df.where(F.col("step") < months).select(*EXAMPLE_KEYS, "step", *features, "y")


def example_arrays(steps: DataFrame, features: Sequence[str]) -> DataFrame:
    """W8 nested form: ``x array<array<double>>`` (step-major), ``y`` double;
    F10 array slicing/indexing/reshape are ``array_sort``/``transform``/``flatten``.

    Groups hold exactly 11 rows after ``example_steps`` (bounded), so the
    ``collect_list`` here is safe at any data size.
    """
    feats = F.array(*[F.col(c).cast("double") for c in features])
    g = (steps.groupBy(*EXAMPLE_KEYS, "split") if "split" in steps.columns
         else steps.groupBy(*EXAMPLE_KEYS))
    agg = g.agg(F.array_sort(F.collect_list(F.struct(F.col("step"), feats.alias("v")))).alias("s"),
                F.first("y").alias("y"))
    return agg.withColumn("x", F.transform("s", lambda e: e["v"])).drop("s")


def count_pixel_years(df: DataFrame, months: int = 12) -> DataFrame:
    """Processed and skipped pixel-years per ``gb_year``."""
    n = df.groupBy(*EXAMPLE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return (n.groupBy("gb_year")
             .agg(F.count_if(F.col("n") == months).alias("processed"),
                  F.count_if(F.col("n") != months).alias("skipped")))


def split_by_year(df: DataFrame, test_year: int) -> DataFrame:
    """``test`` for the test year, ``train`` before it, later years dropped."""
    split = (F.when(F.col("gb_year") == test_year, F.lit("test"))
              .when(F.col("gb_year") < test_year, F.lit("train")))
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def flatten_x(df: DataFrame, x: str = "x", out: str = "features") -> DataFrame:
    """Step-major flatten of ``x`` to one vector (month, then variable)."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.flatten(F.col(x))))


def hide_features(df: DataFrame, features: Sequence[str], hidden: Iterable[str],
                  x: str = "x") -> DataFrame:
    """P25: drop hidden variables from every month of ``x`` (7 -> 4 slots)."""
    hidden = set(hidden)
    keep = [i for i, f in enumerate(features) if f not in hidden]
    return df.withColumn(x, F.transform(F.col(x), lambda m: F.array(*[m[i] for i in keep])))


def lag_stack(df: DataFrame, cols: Sequence[str], lags: int = 3, time: str = "time",
              index: str = "__mi") -> DataFrame:
    """``{var}_t{k}`` = value k months earlier, k = 0..lags.

    Uses a month-index frame ``rangeBetween(-k, -k)``: on a dense cube this
    equals a positional shift, on a sparse one a missing month gives NULL
    (``lag`` would silently take an older row).  One exchange on the pixel
    plus one sort serves every lag of every column.
    """
    mi = F.year(time) * 12 + F.month(time)
    df = df.withColumn(index, mi)
    w = Window.partitionBy(*pixel_keys(df)).orderBy(index)
    out = {}
    for v in cols:
        out[f"{v}_t0"] = F.col(v)
        for k in range(1, lags + 1):
            out[f"{v}_t{k}"] = F.first(v).over(w.rangeBetween(-k, -k))
    return df.withColumns(out).drop(*[c for c in cols]).drop(index)


def shift_time(df: DataFrame, cols: Sequence[str], n: int, time: str = "time") -> DataFrame:
    """``ds.shift(time=n)`` on the monthly calendar: positive n pulls the past forward.

    A month-index frame, as in ``lag_stack``: across a gap the value is missing,
    where a row lag would take the next older row.
    """
    mi = F.year(time) * 12 + F.month(time)
    w = Window.partitionBy(*pixel_keys(df)).orderBy(mi).rangeBetween(-n, -n)
    return df.withColumns({c: F.first(c).over(w) for c in cols})


def flip_lat(df: DataFrame, cols: Sequence[str], time: str = "time") -> DataFrame:
    """Reverse ``cols`` along the latitude axis, coordinates unchanged.

    The lat axis (distinct values; its size is the grid resolution, not the
    data volume) gets rank r and reverse rank; values at the lat of rank r
    move to the lat of reverse rank r through an equi join.  Other
    variables stay in place (left join on the cube keys); a value whose
    mirrored cell does not exist becomes NULL.
    """
    cols = list(cols)
    axis = df.select("lat").distinct()
    ranked = axis.select(
        "lat",
        F.row_number().over(Window.orderBy("lat")).alias("r"),
        F.row_number().over(Window.orderBy(F.col("lat").desc())).alias("rr"))
    mapping = ranked.alias("a").join(ranked.alias("b"), F.col("a.r") == F.col("b.rr")).select(
        F.col("a.lat").alias("__src"), F.col("b.lat").alias("__dst"))
    moved = (df.select("lat", "lon", time, *cols)
               .join(mapping, F.col("lat") == F.col("__src"))
               .select(F.col("__dst").alias("lat"), "lon", time, *cols))
    others = [c for c in df.columns if c not in cols and c not in ("lat", "lon", time)]
    if not others:
        return moved.select(*df.columns)
    return df.drop(*cols).join(moved, ["lat", "lon", time], "left").select(*df.columns)
