"""Sources and sinks (S1-S12) on shared storage.

Everything is written with Spark's own writers: Parquet for cubes and
examples (columnar, predicate and partition pruning), CSV/JSON where the
reference used text files.  Schemas are explicit on read.  Paths are
expected on shared storage; ``scratch_path`` derives one under the
session's checkpoint folder (never a machine-local temp dir).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracube.operators.clean import nan_to_null
from terracube.schema import PIXEL_ID
from terracube.session import checkpoint_dir

STATS_SCHEMA = T.StructType([T.StructField("variable", T.StringType()),
                             T.StructField("mean", T.DoubleType()),
                             T.StructField("std", T.DoubleType())])


def public(df: DataFrame) -> DataFrame:
    """Drop internal helper columns (the pixel hash) before anything is written."""
    return df.drop(PIXEL_ID) if PIXEL_ID in df.columns else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the session ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/terracube-io/{name}-{uuid.uuid4().hex[:12]}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).deleteOnExit(where)
    return path


def cube_schema(variables: Sequence[str], time_type: T.DataType = T.TimestampType()) -> T.StructType:
    return T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
                         T.StructField("time", time_type)]
                        + [T.StructField(v, T.DoubleType()) for v in variables])


def read_cube(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """One path or a list of files/folders of the long cube; NaN is read as missing."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    r = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(r.parquet(*paths))


def write_cube(df: DataFrame, path: str, partition_by_year: bool = True) -> None:
    """Unconditional overwrite; partitioned by year so time slices prune."""
    df = public(df)
    w = df.withColumn("year", F.year("time")) if partition_by_year else df
    w = w.write.mode("overwrite")
    (w.partitionBy("year") if partition_by_year else w).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """S3: header CSV (timestamps in ISO form)."""
    public(df).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with an explicit schema (no inference pass); NaN is read as missing."""
    return nan_to_null(spark.read.schema(schema).option("header", True).csv(path))


def write_stats(stats: DataFrame, path: str) -> None:
    """Normalising statistics as JSON lines (one small file)."""
    public(stats).coalesce(1).write.mode("overwrite").json(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).json(path)


def write_examples(examples: DataFrame, path: str) -> None:
    """Example set partitioned by split."""
    public(examples).write.mode("overwrite").partitionBy("split").parquet(path)


def read_examples(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; the filter prunes the other partition folder."""
    if split not in ("train", "test"):
        raise ValueError(f"split must be train or test, got {split}")
    return spark.read.parquet(path).where(F.col("split") == split)


def write_predictions(preds: DataFrame, path: str) -> None:
    """Keyed predictions (no positional alignment needed on read)."""
    public(preds).write.mode("overwrite").parquet(path)


def save_model(model, path: str) -> None:
    """MLlib model persistence (keeps the intercept)."""
    model.write().overwrite().save(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """S9 read back."""
    return spark.read.parquet(path)


def load_linear_model(path: str) -> LinearRegressionModel:
    """S10 read back."""
    return LinearRegressionModel.load(path)


def to_matrix(df: DataFrame, var: str, time_value, time: str = "time") -> DataFrame:
    """S12 matrix view: one time step as a row per lat with ``lon`` and value arrays in
    longitude order. A row is as long as the longitude axis; no column is made per cell."""
    one = df.where(F.col(time) == F.lit(time_value))
    rows = one.groupBy("lat").agg(F.array_sort(F.collect_list(F.struct("lon", var))).alias("__c"))
    return rows.select("lat", F.col("__c.lon").alias("lon"), F.col(f"__c.{var}").alias(var))
