"""Hard-negative mining by a secondary sort.

A row's score for an anchor is the inner product of their integer vectors (every
component scaled and floored). The pair scores that can matter are packed into keys
(anchor, descending score, id), dealt by anchor and sorted within partitions, so an
iterator meets each anchor's rows from the best down: a row of the anchor's label
opens a window below its score, a row of another label goes to every open window it
fits, a window closes when it is full or its rows have passed. Nothing but the
anchor's open windows is held.

All anchors are scored against all rows, in blocks: rows are dealt to blocks of about
``ROW_BLOCK`` at most by a hash, anchors to blocks of ``ANCHOR_BLOCK``, and a pair of
blocks is a unit that streams its rows past its anchors. Two passes keep the sort small and the
result whole. The first sends each unit's best rows of an anchor's label; the sort
makes them the anchor's positives, whose scores bound its windows. The second sends,
of each unit and window, as many of the best negatives as a window can take. A row
that no unit sends is behind enough others of the same unit, so it is in no result.
What is sorted grows with the units of an anchor, not with the rows.

Defined results: rows with a null id, a null label, a null vector, or a null or
non-finite component take no part, nor do vectors of another length than most (of
equal counts the longer); zero vectors take part (scores 0). Rows that repeat id,
label and vector count once; ids that repeat with other labels or vectors are rows of
their own, and no partner of an anchor with their id. Ties in the score go to the
smaller id. A negative positive score has an empty window. Scores have to fit into
57 bits, else the job fails. Empty tables give an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracube.llm.common import checkpointed

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LEAST_PERCENT, MOST_PERCENT = 80, 100
ROW_BLOCK, ANCHOR_BLOCK = 65_536, 65_536
#: Rows that a block has at least where the session asks for more tasks than there are blocks.
SMALL_BLOCK = 1_024
#: Anchors and rows that are scored at once: bounds the score matrix of a task.
SLICE, CHUNK = 1_024, 512
_EXACT, _LARGEST = 2.0**52, 2.0**56
_NONE = -(2**62)


def integer_vectors(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, in double precision (whole numbers)."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def _usable(vec: Column) -> Column:
    return F.coalesce(~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two whole-number matrices."""
    most = (np.abs(a).max(initial=0.0)) * (np.abs(b).max(initial=0.0)) * a.shape[1]
    if most < _EXACT:  # every partial sum is a whole number that a double holds
        return (a @ b.T).astype(np.int64)
    if most >= _LARGEST:
        raise ValueError("a score does not fit into 57 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The k best rows of each of several lists, from rows that come in ascending ids."""

    def __init__(self, k: int, below: np.ndarray):
        self.score = np.repeat(below[:, None], k, axis=1)  # descending; a row has to be above
        self.at = np.full(self.score.shape, -1, np.int64)

    def offer(self, score: np.ndarray, allowed: np.ndarray, number: np.ndarray) -> None:
        """``score, allowed``: lists x rows; of equal scores the earlier row stays in front."""
        k = self.score.shape[1]
        rows = np.flatnonzero((allowed & (score > self.score[:, -1:])).any(axis=1))
        if not len(rows):
            return
        part = np.where(allowed[rows], score[rows], _NONE)
        if part.shape[1] > 4 * k:  # only rows at or above the part's k-th best can enter
            kth = np.partition(part, part.shape[1] - k, axis=1)[:, -k]
            few = np.flatnonzero((part >= np.maximum(kth, self.score[rows, -1] + 1)[:, None]).any(axis=0))
            part, number = part[:, few], number[few]
        both = np.concatenate([self.score[rows], part], axis=1)
        at = np.concatenate([self.at[rows], np.broadcast_to(number, part.shape)], axis=1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :k]
        self.score[rows], self.at[rows] = np.take_along_axis(both, order, 1), np.take_along_axis(at, order, 1)


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, pd.DataFrame]]:
    """Frames of one unit and kind each from batches sorted by unit, kind and id; True where a unit begins."""
    unit = None
    for pdf in batches:
        key = pdf[["row_block", "anchor_block", "kind"]].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(pdf)] if len(pdf) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            here = tuple(key[a][:2])
            yield here != unit, pdf.iloc[a:b]
            unit = here


class _Slice:
    """Some anchors of a unit and the best rows so far: of their label, or (with windows) of each window."""

    def __init__(self, anchors: pd.DataFrame, k: int, least: int, most: int):
        self.ids, self.twins, self.labels = (anchors[c].to_numpy() for c in ("id", "twin", "label"))
        self.vectors = np.stack(anchors["vec"].to_numpy())
        windows = [np.asarray(w, np.int64) for w in anchors["windows"]]
        self.mining = any(len(w) for w in windows)
        if self.mining:
            self.owner, high = np.repeat(np.arange(len(anchors)), [len(w) for w in windows]), np.concatenate(windows)
            self.top, self.best = most * high // 100, Best(k, -(-least * high // 100) - 1)
        else:
            self.owner, self.best = np.arange(len(anchors)), Best(k, np.full(len(anchors), _NONE + 1))

    def offer(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, number: np.ndarray) -> None:
        s = scores(self.vectors, vectors)
        other, same = self.ids[:, None] != ids[None, :], self.labels[:, None] == labels[None, :]
        if self.mining:
            s, allowed = s[self.owner], (other & ~same)[self.owner]
            self.best.offer(s, allowed & (s <= self.top[:, None]), number)
        else:
            self.best.offer(s, other & same, number)

    def found(self, ids: np.ndarray) -> pd.DataFrame:
        """The kept pairs, each once."""
        lists, place = np.nonzero(self.best.at >= 0)
        at, owner = self.best.at[lists, place], self.owner[lists]
        pairs = pd.DataFrame({"anchor_id": self.ids[owner], "twin": self.twins[owner], "score": self.best.score[lists, place], "id": ids[at], "at": at, "positive": not self.mining})
        return pairs.drop_duplicates(["anchor_id", "twin", "at"]).drop(columns="at")


def _paired(k: int, least: int, most: int):
    """Of every unit the pairs that can matter."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, slices, ids, seen = [], [], [], 0
        for begins, pdf in _units(batches):
            if begins:
                for x in slices:
                    yield x.found(np.concatenate(ids))
                anchors, slices, ids, seen = [], [], [], 0
            if pdf["kind"].iloc[0] == 0:
                anchors.append(pdf)
                continue
            if anchors:
                whole = pd.concat(anchors, ignore_index=True)
                slices, anchors = [_Slice(whole.iloc[a : a + SLICE], k, least, most) for a in range(0, len(whole), SLICE)], []
            if not slices:
                continue
            for a in range(0, len(pdf), CHUNK):
                part = pdf.iloc[a : a + CHUNK]
                ids.append(part["id"].to_numpy())
                for x in slices:
                    x.offer(ids[-1], part["label"].to_numpy(), np.stack(part["vec"].to_numpy()), np.arange(seen, seen + len(part)))
                seen += len(part)
        for x in slices:
            yield x.found(np.concatenate(ids))

    return run


def _by_anchor(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[bool, tuple]]:
    anchor = None
    for pdf in batches:
        for row in pdf[columns].itertuples(index=False, name=None):
            yield row[:2] != anchor, row
            anchor = row[:2]


def _first(k: int):
    """The first k rows of each anchor in key order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken, out = 0, []
        for begins, row in _by_anchor(batches, ["anchor_id", "twin", "score", "id"]):
            taken = 1 if begins else taken + 1
            if taken <= k:
                out.append(row)
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["anchor_id", "twin", "score", "id"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["anchor_id", "twin", "score", "id"])

    return run


_RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _windows(k: int, least: int, most: int):
    """Opens a window at each positive and emits the negatives that fall into it, from sorted keys."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows, out = [], []
        for begins, (anchor, _, score, number, positive) in _by_anchor(batches, ["anchor_id", "twin", "score", "id", "positive"]):
            if begins:
                windows = []
            if positive:
                windows.append([number, score, 0])
                continue
            windows = [w for w in windows if w[2] < k and least * w[1] <= 100 * score]  # others are full or have passed
            for w in windows:
                if 100 * score <= most * w[1]:
                    w[2] += 1
                    out.append((anchor, w[0], w[2], number, w[1], score))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=_RESULT)
                out = []
        if out:
            yield pd.DataFrame(out, columns=_RESULT)

    return run


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT,
         most_percent: int = MOST_PERCENT, scale: int = SCALE, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each of an anchor's
    best ``positives`` rows of its label the best ``negatives`` rows of other labels whose score lies
    between ``least_percent`` and ``most_percent`` (at most 100) of the positive's."""
    if not 0 <= least_percent <= most_percent <= 100:
        raise ValueError("a window ends at its positive's score")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vec")))
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    result = f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, positive_score long, negative_score long"
    sizes = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows"), F.count_if("asks").alias("anchors")).orderBy(F.desc("rows"), F.desc("n")).first()
    if sizes is None or not sizes["anchors"]:
        return vectors.sparkSession.createDataFrame([], result)
    whole = rows.where(F.size("vec") == sizes["n"]).select("id", "label", integer_vectors(F.col("vec"), scale).alias("vec"), "asks")
    whole = whole.withColumn("twin", F.xxhash64("label", "vec")).dropDuplicates(["id", "twin"])
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_blocks, anchor_blocks = max(-(-sizes["rows"] // row_block), min(tasks, -(-sizes["rows"] // SMALL_BLOCK))), -(-sizes["anchors"] // anchor_block)
    whole = checkpointed(whole.withColumn("block", F.pmod(F.xxhash64("id", "twin"), F.lit(row_blocks)).cast("int")))
    anchors = whole.where("asks").withColumn("anchor_block", F.pmod(F.xxhash64("twin", "id"), F.lit(anchor_blocks)).cast("int"))

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    no_windows = F.array().cast("array<long>")
    beside = whole.select("id", "twin", "label", "vec", F.col("block").alias("row_block"), every(anchor_blocks).alias("anchor_block"), F.lit(1).alias("kind"), no_windows.alias("windows"))
    pairs = f"anchor_id {id_type}, twin long, score long, id {id_type}, positive boolean"
    unit, key = ["row_block", "anchor_block"], ["anchor_id", "twin"]

    def paired(asking: DataFrame, k: int) -> DataFrame:
        asked = asking.select("id", "twin", "label", "vec", every(row_blocks).alias("row_block"), "anchor_block", F.lit(0).alias("kind"), "windows")
        dealt = asked.unionByName(beside).repartition(*unit).sortWithinPartitions(*unit, "kind", "id")
        return dealt.mapInPandas(_paired(k, least_percent, most_percent), pairs)

    best = paired(anchors.withColumn("windows", no_windows), positives).repartition(*key).sortWithinPartitions(*key, F.desc("score"), "id")
    best = checkpointed(best.mapInPandas(_first(positives), f"anchor_id {id_type}, twin long, score long, id {id_type}"))
    windows = best.groupBy(*key).agg(F.sort_array(F.collect_set("score"), asc=False).alias("windows"))
    asking = anchors.join(windows, (anchors["id"] == windows["anchor_id"]) & (anchors["twin"] == windows["twin"])).select(
        "id", anchors["twin"], "label", "vec", "anchor_block", "windows")
    near = paired(asking, negatives).unionByName(best.withColumn("positive", F.lit(True)))
    # of equal scores the positive comes first: its window takes in its own score
    packed = near.repartition(*key).sortWithinPartitions(*key, F.desc("score"), F.desc("positive"), "id")
    return packed.mapInPandas(_windows(negatives, least_percent, most_percent), result)
