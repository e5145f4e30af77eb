"""Incremental monthly resample of daily observation files (A4 as a stream).

New daily files land in a folder; a Structured Streaming query keeps, per
pixel and month, the first non-missing value in time order. Complete mode: every
run replaces the result with all months, the open one included, so nothing waits
for a watermark. State is one (time, value) candidate per pixel-month, the size
of the result; the checkpoint lives in the shared checkpoint folder so a
restarted driver resumes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def monthly_first_stream(stream: DataFrame, keys: Sequence[str], var: str, time: str = "time") -> DataFrame:
    """Streaming aggregation: month-start key, first non-null value by time."""
    s = stream.withColumn("month", F.date_trunc("month", F.col(time)).cast("timestamp"))
    return (s.groupBy(*keys, "month")
             .agg(F.min_by(F.col(var), F.when(F.col(var).isNotNull(), F.col(time))).alias(var),
                  F.count(F.col(var)).alias("n_obs")))


def run_monthly_first(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
                      var: str, out_path: str, checkpoint: str, time: str = "time", glob: str | None = None) -> None:
    """Process everything available now and write all months to Parquet."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    agg = monthly_first_stream(reader.parquet(source_dir), keys, var, time)

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()
