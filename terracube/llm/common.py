"""Shared column helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracube.session import cut_lineage

#: Word separators of every operator here: the space and \t \n \x0B \f \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Rows up to which a counted side table is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 20_000
#: Rows of one value that a task of a dealt join takes, and the bound of hot values.
DEALT_ROWS, HOT_KEYS = 50_000, 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def null_key(col: Column) -> Column:
    """A non-null join key: null becomes a key of its own that no string equals."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("null"))


def packed(df: DataFrame, *extra: Column) -> DataFrame:
    """The input row as one struct ``row``, so that no input column can clash with a working column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *extra)


def join_counted(df: DataFrame, side: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join a per-group table that was checkpointed: counted first, broadcast up to
    ``BROADCAST_ROWS`` rows, else a shuffle join whose skew AQE splits."""
    small = side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(side) if small else side, on, how)


def dealt_join(df: DataFrame, side: DataFrame, on: str, by: list[str], how: str = "inner", parts: int = 16, rows: str | None = None) -> DataFrame:
    """Join a table of one row per ``on`` part by part: ``df`` is dealt by a hash of the columns
    ``by`` and ``side`` repeated for each part, so a hot value is not in one task.

    With ``rows``, a column of ``side`` with the number of rows of ``df`` per value, only hot values
    are dealt, each to as many parts as its rows need; ``side`` should be checkpointed then.
    """
    if rows is None:
        dealt = side.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return df.withColumn("__part", F.pmod(F.xxhash64(*by), F.lit(parts).cast("long"))).join(dealt, [on, "__part"], how).drop("__part")
    # a part has at least a HOT_KEYS-th of all matching rows, so fewer values than that are hot
    size = max(DEALT_ROWS, (side.agg(F.sum(rows)).first()[0] or 0) // HOT_KEYS)
    n_parts = F.ceil(F.col(rows) / size).cast("long")
    hot = side.where(F.col(rows) > size).select(on, n_parts.alias("__parts"))
    dealt = side.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1)))
    df = df.join(F.broadcast(hot), on, "left").withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*by), F.col("__parts")), F.lit(0).cast("long")))
    return df.drop("__parts").join(dealt, [on, "__part"], how).drop("__part")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that the cluster names (``spark.checkpoint.dir``)."""
    return cut_lineage(df)
