"""Interaction audit of document filters by incremental retraction streaming.

Filters overlap: what one removes, another would have removed as well. The audit
counts, for every order of the filters, what each step keeps, removes and finds
removed already, and what only this filter removes.

All files of a table are processed as available-now micro-batches of a stream. Each
document becomes a mask of the filters it fails. All filters but one look at the
document alone. The last one, exact duplicates, fails a text that a smaller id has
too, anywhere in the table. Keyed state holds, per text digest, the smallest id so far
and the mask it was counted with (entries of the state store hold about ``BUCKET``
texts, as many entries as the table needs). A row with a larger id counts with the duplicate
bit. When a smaller id arrives, the earlier mask is taken back (a negative count) and
counted again with the bit. The stream appends these signed counts; their sums are
the part counters, right after every micro-batch and independent of the order of
files. Progress and state lie in the shared checkpoint folder, so a lost executor or
driver resumes with the last finished batch; with a ``state_dir`` of its own, a later
call adds new files only. The session's state store is used as it is set; one that
keeps state on disk (``spark.sql.streaming.stateStore.providerClass``) is for states
beyond the executors' memory, some 50 bytes a text.

A text that holds a third of all rows does not meet in one task: each Arrow batch
first combines its rows of a text, and only its smallest id competes; the others are
duplicates whatever follows. Counters have at most a row per part, mask and labels;
what orders and steps say is derived from those.

Defined results: a null text is empty, a null part is the empty string; a null id has
no smaller one and is no smaller one; rows that repeat id and text do not fail each
other; a document is good (toxic) if one of its label rows says so, and neither
without one; an empty table gives an empty result; other columns are ignored. Texts
count as identical if their MD5 digests and lengths are.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracube.llm.common import checkpointed, words
from terracube.sources.io import scratch_path

#: Micro-batches that the files are dealt to (at most; a file is not divided).
BATCHES = 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROW, _SURE, _NAMELESS = 0, 1, 2
_HELD = ["key", "id", "part", "bits", "n"]
#: Texts that share an entry of the state store (in the mean).
BUCKET = 1_000


def text_filters(text: Column, w: Column) -> dict[str, Column]:
    """The filters on a document alone: its text (not null) and its words."""
    return {"A": F.size(w) < 100,
            "B": 100 * F.size(F.array_distinct(w)) < 80 * F.size(w),
            "C": 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > 10 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def masks(docs: DataFrame, filters=text_filters, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id, key, part, mask`` of every document; ``key`` is the digest of its text, bit k of ``mask`` the k-th filter."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("text"))
    df = df.withColumn("words", words(F.col("text")))
    failed = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(filters(F.col("text"), F.col("words")).values())]
    key = F.concat(F.unhex(F.md5("text")), F.unhex(F.lpad(F.hex(F.length("text")), 8, "0")))
    return df.select("id", key.alias("key"), "part", sum(failed[1:], failed[0]).cast("int").alias("mask"))


def _combined(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a batch per text: the smallest id's, and counts of the others, which are duplicates whatever follows."""
    for pdf in batches:
        named = pdf["kind"] == _ROW
        least = pdf.loc[named, "id"].groupby(pdf.loc[named, "key"]).min()
        least = pdf["key"].map(least).where(named, pdf["id"]) if len(pdf) else pdf["id"]
        kind = pdf["kind"].mask(named & (pdf["id"] > least), _SURE)
        rows = pdf.assign(id=least.astype(pdf["id"].dtype), kind=kind, n=1).groupby(["key", "id", "part", "bits", "kind"], as_index=False, sort=False)["n"].sum()
        yield rows[["id", "key", "part", "bits", "kind", "n"]].astype({"kind": "int32", "n": "int64"})


def _signed(rows: pd.DataFrame, old: pd.DataFrame, duplicate: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Signed counts ``part, bits, n`` of new rows against the smallest ids so far, and the smallest ids now."""
    fresh = rows["kind"] == _ROW
    both = pd.concat([old.assign(known=True), rows.loc[fresh, _HELD].assign(known=False)], ignore_index=True)
    least = both["id"] == both.groupby("key")["id"].transform("min")
    held, gone = both[least], both[~least]
    back = gone[gone["known"]]  # counted without the bit before
    plain = [held[~held["known"]], rows[rows["kind"] == _NAMELESS], back.assign(n=-back["n"])]
    marked = pd.concat([gone, rows[rows["kind"] == _SURE]])
    out = pd.concat([*plain, marked.assign(bits=marked["bits"] | duplicate)])[["part", "bits", "n"]]
    return out.groupby(["part", "bits"], as_index=False).sum(), held.groupby(["key", "id", "part", "bits"], as_index=False)["n"].sum()


def _retraction(duplicate: int):
    """One step of a bucket of texts: state is the table of its texts' smallest ids with their masks."""
    def run(_, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        old = pickle.loads(state.get[0]) if state.exists else rows.iloc[:0][_HELD]
        out, held = _signed(rows, old, duplicate)
        state.update((pickle.dumps(held),))
        yield out.astype({"bits": "int32", "n": "int64"})

    return run


def counters(spark: SparkSession, path: str, labels: DataFrame, filters=text_filters, batches: int = BATCHES, state_dir: str | None = None,
             buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, good, toxic, n`` of the documents under ``path``: the filters' bits, the duplicate
    bit behind them, and how many documents have them. ``state_dir`` keeps state and
    counters for later calls, which need the number of ``buckets`` that the first one had."""
    if state_dir and not buckets:
        raise ValueError("a state that is kept needs a fixed number of buckets")
    table = spark.read.parquet(path)
    buckets = buckets or math.ceil(table.count() / BUCKET) or 1
    bits = len(filters(F.lit(""), F.array(F.lit(""))))
    base = (state_dir or scratch_path(spark, "filter-audit")).rstrip("/")
    told = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        *[F.max(F.when(c, 1 << (bits + 1 + k)).otherwise(0)).alias(n) for k, (n, c) in enumerate(told.items())])
    # null ids have no label: they are spread over the tasks of the join by their text
    said = checkpointed(said.select(F.col("id").alias("label_id"), F.pmod(F.xxhash64("id"), F.lit(1)).alias("spot"), (F.col("good") + F.col("toxic")).alias("labelled")))
    files, name = table.inputFiles(), path.rstrip("/").rsplit("/", 1)[-1]
    if [f.rsplit("/", 1)[-1] for f in files] == [name]:  # a stream reads a folder or a pattern: one that only this file has
        path = f"{path.rstrip('/')[:-1]}[{name[-1]}]"
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, math.ceil(len(files) / batches))).parquet(path)
    rows = masks(stream, filters, id_col, text_col, part_col).withColumn("spot", F.when(F.col("id").isNull(), F.xxhash64("key")).otherwise(F.lit(0)))
    rows = rows.join(said, (rows["id"] == said["label_id"]) & (rows["spot"] == said["spot"]), "left")
    id_type = table.schema[id_col].dataType.simpleString()
    rows = rows.select(F.coalesce("id", F.lit("0").cast(id_type)).alias("id"), "key", "part", (F.col("mask") + F.coalesce("labelled", F.lit(0))).cast("int").alias("bits"),
                       F.when(F.col("id").isNull(), _NAMELESS).otherwise(_ROW).alias("kind"))
    rows = rows.mapInPandas(_combined, f"id {id_type}, key binary, part string, bits int, kind int, n long")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    signed = rows.groupBy("bucket").applyInPandasWithState(_retraction(1 << bits), "part string, bits int, n long", "held binary", "append", "NoTimeout")
    run = signed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start(f"{base}/counts")
    run.awaitTermination()
    signed = spark.read.schema("part string, bits int, n long").parquet(f"{base}/counts")
    per = checkpointed(signed.groupBy("part", "bits").agg(F.sum("n").alias("n")).where("n <> 0"))
    flag = lambda k: F.getbit("bits", F.lit(k)).cast("int")
    return per.select("part", F.col("bits").bitwiseAND((2 << bits) - 1).alias("mask"), flag(bits + 1).alias("good"), flag(bits + 2).alias("toxic"), "n")


def interactions(cells: DataFrame, names: str) -> DataFrame:
    """``part, filter_order, step, filter`` and its counts, for all orders of the filters
    (``names``: a letter per bit of ``mask``); ``cells`` as ``counters`` returns them."""
    k = len(names)
    steps = []
    for order in permutations(range(k)):
        gone = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[x] for x in order), step, names[f], 1 << f, gone, gone | 1 << f))
            gone |= 1 << f
    spark = cells.sparkSession
    steps = spark.createDataFrame(steps, "filter_order string, step int, filter string, bit int, before int, after int")  # k * k! rows
    n, good, toxic = F.col("n"), F.col("n") * F.col("good"), F.col("n") * F.col("toxic")

    cell = cells.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1))))
    passes = F.col("mask").bitwiseAND(F.col("set")) == 0
    left = cell.groupBy("part", "set").agg(*[F.sum(F.when(passes, v).otherwise(0)).alias(c) for c, v in (("n", n), ("good", good), ("toxic", toxic))])
    left = checkpointed(left)  # a row per part and set of filters: what passes all of the set
    each = cells.withColumn("bit", F.explode(F.array(*[F.lit(1 << b) for b in range(k)])))
    fails, orders = F.col("mask").bitwiseAND(F.col("bit")) != 0, math.factorial(k)
    # of a document's failed filters each comes first in an equal share of the orders
    share = F.element_at(F.array(*[F.lit(orders // c) for c in range(1, k + 1)]), F.greatest(F.bit_count("mask"), F.lit(1)))
    total = each.groupBy("part", "bit").agg(
        F.sum(F.when(fails, n).otherwise(0)).alias("fails"), F.sum(F.when(F.col("mask") == F.col("bit"), n).otherwise(0)).alias("unique_fails"),
        F.sum(F.when(fails, n * share).otherwise(0)).alias("shapley"))
    before = left.select("part", F.col("set").alias("before"), F.col("n").alias("n0"), F.col("good").alias("good0"), F.col("toxic").alias("toxic0"))
    after = left.select("part", F.col("set").alias("after"), F.col("n").alias("kept"), F.col("good").alias("good1"), F.col("toxic").alias("toxic1"))
    df = before.join(F.broadcast(steps), "before").join(after, ["part", "after"]).join(total, ["part", "bit"])
    removed = F.col("n0") - F.col("kept")
    return df.select("part", "filter_order", "step", "filter", "kept", removed.alias("removed"), (F.col("fails") - removed).alias("redundant"), "unique_fails",
                     (F.col("good0") - F.col("good1")).alias("good_lost"), (F.col("toxic0") - F.col("toxic1")).alias("toxic_lost"), "shapley")
