"""Mixing sources to target weights (DataFrame functions only).

Sizes are summed per source, targets follow the weights with a ceiling on
repetition, and a document is repeated floor(rate) times plus once more with
probability equal to the fraction, drawn from a hash of its id. So reruns and
lost executors give the same copies, and no document is shuffled: the per-source
table is counted and joined to the scan.

Defined results: a null or blank text has size 0 and its copies take nothing;
the null source comes last; documents with a null id are drawn by a hash of
their text; repeated rows get equal draws; a source without words has target 0;
an empty table gives an empty result; clashing column names are kept apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from terracube.llm.common import checkpointed, join_counted, null_key, packed, words

WEIGHTS = (5, 2, 1)
CEILING = 3


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``place`` (from 0) in code-point order, null last, without a global window.

    Sorted in range partitions and numbered inside each; the partitions' row
    counts give the offsets.
    """
    part = checkpointed(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    counts = part.groupBy("part").count()
    offsets = counts.select("part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("offset"))
    within = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return part.withColumn("within", within).join(offsets, "part").withColumn("place", F.col("offset") + F.col("within")).drop("part", "within", "offset")


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, ceiling: float = CEILING) -> DataFrame:
    """``key, source, source_size, target`` from rows of ``source, size``.

    Sources weigh ``weights`` in turn and share all sizes; a target stops at
    ``ceiling`` times its source's size and the excess is shared again by weight
    until none is above. Each round is one aggregate row over the source table;
    a round without a new ceiling ends it.
    """
    per = ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    per = checkpointed(per.withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")))
                       .withColumn("most", F.col("source_size") * float(ceiling)))
    level, full = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("most") <= F.lit(level) * F.col("weight")
        row = per.agg(F.sum("source_size").alias("total"), F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("used"),
                      F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.sum(capped.cast("long")).alias("full")).first()
        if not row["open"] or row["full"] == full:
            break
        level, full = (row["total"] - row["used"]) / row["open"], row["full"]
    share = F.lit(float(level or 0.0)) * F.col("weight")
    return per.select(null_key(F.col("source")).alias("key"), "source", "source_size", F.least("most", share).alias("target"))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """Uniform in [0, 1) from the first 52 bits of an MD5 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") / float(2**52)


def repetitions(docs: DataFrame, weights: Sequence[float] = WEIGHTS, ceiling: float = CEILING, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``row`` (the input row), ``size, source_size, target, rate, copies`` per document."""
    source, text, doc_id = F.col(source_col), F.col(text_col), F.col(id_col)
    per = checkpointed(targets(docs.select(source.alias("source"), size_of(text).alias("size")), weights, ceiling)).drop("source")
    df = packed(docs, null_key(source).alias("key"), size_of(text).alias("size"), draw(doc_id, text, seed).alias("draw"))
    df = join_counted(df, per, "key").withColumn("rate", F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    whole = F.floor("rate")
    return df.withColumn("copies", (whole + (F.col("draw") < F.col("rate") - whole).cast("long")).cast("long")).drop("key", "draw")


def mix(docs: DataFrame, copy_col: str | None = None, **options) -> DataFrame:
    """The mixture: each document as often as its copies say, in the columns of ``docs``
    (and ``copy_col``, from 1, in place of a column of that name)."""
    df = repetitions(docs, **options).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    rest = [F.col("row")[c].alias(c) for c in docs.columns if c != copy_col]
    return df.select(*rest, *([F.col("copy").alias(copy_col)] if copy_col else []))
