"""Session construction and lineage cutting.

The cluster names a shared checkpoint folder in ``spark.checkpoint.dir``;
we only set one ourselves when the session has none (local tests).
"""

from __future__ import annotations

import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Defaults for keys that neither the submitter nor an existing session has set.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # model-input checkpoints are removed once their DataFrame is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Only one-row statistics and fixed lookup tables are hinted; axis, calendar,
    # mask and other tables are measured by AQE at run time against this.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "terracube") -> SparkSession:
    """The active session as it is, or a new one whose unset keys get the defaults."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        SparkContext._ensure_initialized()
        conf = SparkConf()  # what the submitter has set
        for k, v in _DEFAULTS.items():
            conf.setIfMissing(k, v)
        if shuffle_partitions:
            conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
        builder = SparkSession.builder.appName(app_name).config(conf=conf)
        spark = (builder.master(master) if master else builder).getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master, whose executors are this process, gets a scratch folder
    when the setting is missing; anywhere else that is an error, as executors
    would write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="terracube-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never ``localCheckpoint``).

    Used where a plan is consumed twice and recomputation after executor loss
    must see identical rows (e.g. fitted-model inputs).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)



def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitioned by ``keys`` into as many parts as ``spark.sql.shuffle.partitions`` says.

    For an aggregate that combines few rows per key, and for rows that a generator makes many of:
    no task holds a map of its input's keys, and a given number is not coalesced by the bytes read.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
