"""Cubes laid out by space and time (S7/S1), and guarded writes with a commit record.

Layout: a cell's place along the Morton order of (latitude, longitude, month) is the
interleaving of their quantised bits, by column arithmetic. A cube is written in ranges
of that order, so a file covers a compact box. A small table has each file's bounds, and
a box read opens only the files whose bounds meet it.

Commit record: data are written to a folder of their own under the target, and then one
small manifest that names the folder, its rows and its schema is renamed into place. What
a failed write leaves behind is named by no manifest, so it neither counts as written nor
is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracube.operators.clean import nan_to_null
from terracube.sources.io import public

BITS = 16
_DATA, _BOUNDS, _MANIFEST = "data", "bounds", "manifest.json"


def _spaced(v: Column) -> Column:
    """The 16 bits of ``v`` with two zeros between neighbours."""
    v = v.cast("long")
    for shift, mask in ((16, 0xFF0000FF), (8, 0xF00F00F00F), (4, 0xC30C30C30C3), (2, 0x249249249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(mask)
    return v


def morton_key(lat: Column, lon: Column, time: Column) -> Column:
    """Place on the Morton order: latitude and longitude in 1/65536 of their range, months since year 0."""
    part = lambda v, low, span: F.least(F.floor((v - low) / span * (1 << BITS)), F.lit((1 << BITS) - 1))
    month = F.year(time) * 12 + F.month(time) - 1
    return _spaced(part(lat, -90.0, 180.0)).bitwiseOR(F.shiftleft(_spaced(part(F.pmod(lon + 180.0, F.lit(360.0)), 0.0, 360.0)), 1)).bitwiseOR(
        F.shiftleft(_spaced(F.pmod(month, F.lit(1 << BITS))), 2))


def write_cube_blocks(df: DataFrame, path: str, files: int = 64, time: str = "time") -> None:
    """The cube in ``files`` ranges of the Morton order, and the table of their bounds."""
    df = public(df).withColumn("__key", morton_key(F.col("lat"), F.col("lon"), F.col(time)))
    df.repartitionByRange(files, "__key").sortWithinPartitions("__key").drop("__key").write.mode("overwrite").parquet(f"{path}/{_DATA}")
    back = df.sparkSession.read.parquet(f"{path}/{_DATA}").select("lat", "lon", time, F.col("_metadata.file_path").alias("file"))
    ends = [f(c).alias(f"{c}_{n}") for c in ("lat", "lon", time) for n, f in (("min", F.min), ("max", F.max))]
    back.groupBy("file").agg(F.count("*").alias("n"), *ends).write.mode("overwrite").parquet(f"{path}/{_BOUNDS}")


def read_cube_blocks(spark: SparkSession, path: str, lat: tuple | None = None, lon: tuple | None = None, time: tuple | None = None) -> DataFrame:
    """The rows of an inclusive box, from the files whose bounds meet it (their names are
    what the driver gets). Parquet's own statistics prune within them."""
    box = {c: b for c, b in (("lat", lat), ("lon", lon), ("time", time)) if b is not None}
    lit = lambda c, v: F.lit(v).cast("timestamp_ntz") if c == "time" else F.lit(v)
    found = spark.read.parquet(f"{path}/{_BOUNDS}")
    for c, (low, high) in box.items():
        found = found.where((F.col(f"{c}_max") >= lit(c, low)) & (F.col(f"{c}_min") <= lit(c, high)))
    names = [r["file"] for r in found.select("file").collect()]
    whole = spark.read.parquet(f"{path}/{_DATA}")
    df = spark.read.schema(whole.schema).parquet(*names) if names else whole.limit(0)
    for c, (low, high) in box.items():
        df = df.where(F.col(c).between(lit(c, low), lit(c, high)))
    return nan_to_null(df)


# ------------------------------------------------------------------- commit record


def _files(spark: SparkSession, path: str):
    """The folder's file context and Hadoop's Path class."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.getFileSystem(conf).makeQualified(where).toUri(), conf), jvm.org.apache.hadoop.fs.Path


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What was published under ``path``: its folder, rows and schema; nothing if no write was finished."""
    context, hadoop_path = _files(spark, path)
    name = hadoop_path(f"{path}/{_MANIFEST}")
    if not context.util().exists(name):
        return None
    return json.loads("\n".join(r[0] for r in spark.read.text(f"{path}/{_MANIFEST}").collect()))  # one short line


def guarded_write(df: DataFrame, path: str, force: bool = False) -> bool:
    """Write if nothing was published under ``path``, or with ``force``; whether it wrote.

    Readers see the former data until the manifest is renamed, in one step."""
    spark, df = df.sparkSession, public(df)
    if not force and manifest(spark, path) is not None:
        return False
    folder, rows = f"version-{uuid.uuid4().hex[:12]}", Observation()
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folder}")
    _publish(spark, path, {"folder": folder, "rows": rows.get["rows"], "schema": json.loads(df.schema.json())})
    return True


def _publish(spark: SparkSession, path: str, record: dict) -> None:
    jvm = spark.sparkContext._jvm
    context, hadoop_path = _files(spark, path)
    staged = hadoop_path(f"{path}/_staged-{uuid.uuid4().hex[:12]}")
    out = staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(staged, True)
    try:
        out.write(json.dumps(record).encode())
    finally:
        out.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(staged, hadoop_path(f"{path}/{_MANIFEST}"), rename)


def read_guarded(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """What was published last under ``path``."""
    told = manifest(spark, path)
    if told is None:
        raise FileNotFoundError(f"nothing was published under {path}")
    df = spark.read.schema(T.StructType.fromJson(told["schema"])).parquet(f"{path}/{told['folder']}")
    return df.select(*columns) if columns else df
