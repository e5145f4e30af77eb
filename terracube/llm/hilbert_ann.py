"""Approximate nearest neighbours (cosine) by shifted Hilbert orderings.

Unit vectors are projected onto a few random directions, shifted and quantised,
and their Hilbert index is the key of an ordering; several orderings differ in
directions and shift. Each ordering is range-partitioned by key in Spark and
numbered, and a query is compared with the window of rows around its position.
The windows of all orderings merge, scores are exact cosines of the original
vectors.

Rows are dealt in blocks of ``BLOCK`` positions; a query goes to the blocks that
its window touches, where it meets the block's rows and sends back its best few.
So a task holds one block and a batch of queries, whatever the window.

The window is fitted: at most ``FIT_QUERIES`` queries are compared with all rows
once, and the window is the distance within which the wanted share of their true
neighbours lies in some ordering. Scales of the projections come from at most
``FIT_ROWS`` rows. Every row is indexed.

Vectors are divided by their largest component, as the scores do, and equal ones
(so also exact multiples) are one entry of the index that knows its k + 1 smallest
ids: a vector found a million times costs one row and ties still go to the smallest ids.
Scores are at most 1. A tie is an equal score in that computation: multiples by powers
of two always tie, others may differ in the last bit.

Defined results: vectors that are null, zero, or hold null or non-finite
components, or have another length than most (of equal counts the longer) take
no part; a null id takes no part; rows that repeat id and direction count once; ids
that repeat with other directions are entries of their own (as queries, too: each has
its list), and no row is a neighbour of a query with its id; an empty table gives an
empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from terracube.llm.common import checkpointed

ORDERINGS = 8
DIMENSIONS, BITS = 8, 7
BLOCK = 4096
#: Rounding of a first score; rows within it of the k-th best get the exact score.
MARGIN = 1e-9
RECALL = 0.96
FIT_ROWS, FIT_QUERIES = 10_000, 200


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index of grid cells (rows of ``cells``, below 2^bits) along a Hilbert curve.

    Level by level from the coarsest: the cell's bits in the current frame give the
    Gray-coded position, and the frame of the next level is mirrored and turned.
    """
    n = cells.shape[1]
    x = [cells[:, i].astype(np.int64) for i in range(n)]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            up = (x[i] >> level) & 1 == 1
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1 == 1, turn ^ ((1 << level) - 1), turn)
    out = np.zeros_like(turn)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ turn) >> level) & 1)
    return out


def usable(vec: Column) -> Column:
    """Has a direction: no null or non-finite component, and not all zero."""
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(rows: pd.Series) -> np.ndarray:
    m = np.stack(rows.to_numpy()).astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _cosines(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact scores of one vector with rows, in a fixed summing order."""
    q, m = q.astype(np.float64), m.astype(np.float64)
    q, m = q / np.abs(q).max(), m / np.abs(m).max(axis=1, keepdims=True)
    return np.minimum(1.0, (m * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((m * m).sum(axis=1))))


def _keys(directions: np.ndarray, middle: np.ndarray, spread: np.ndarray, shift: np.ndarray, bits: int):
    """Rows ``ordering, key`` of every entry (all orderings)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            unit = _unit(pdf["vec"])
            for g in range(len(directions)):
                at = np.clip(((unit @ directions[g] - middle[g]) / spread[g] + 4) / 16 + shift[g] / 2, 0, 1 - 1e-9)
                yield pd.DataFrame({"ordering": g, "key": hilbert((at * (1 << bits)).astype(np.int64), bits), "entry": pdf["entry"].to_numpy(), "id": pdf["id"].to_numpy(), "kind": pdf["kind"].to_numpy()})

    return run


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Numbers sorted rows within their partition and ordering; queries (kind 1) take no number."""
    part, ordering, base = TaskContext.get().partitionId(), None, 0
    for pdf in batches:
        g, entry = pdf["ordering"].to_numpy(), (pdf["kind"] == 0).to_numpy().astype(np.int64)
        within = np.zeros(len(pdf), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]]) if len(g) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if g[a] != ordering:
                ordering, base = g[a], 0
            within[a:b] = base + np.cumsum(entry[a:b]) - entry[a:b]
            base += int(entry[a:b].sum())
        yield pd.DataFrame({"ordering": g, "entry": pdf["entry"], "kind": pdf["kind"], "part": part, "within": within})


def _best(k: int):
    """Of each block's queries the k best rows within their windows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, names, ids, pos, raw, unit = None, None, None, None, None, None
        for pdf in batches:
            out = []
            for (g, block, kind), rows in pdf.groupby(["ordering", "block", "kind"], sort=True):
                if kind == 0:
                    same = where == (g, block)  # a block's rows may span batches
                    where, old = (g, block), (names, ids, pos, raw)
                    names, ids, pos, raw = rows["entry"].to_numpy(), rows["id"].to_numpy(), rows["pos"].to_numpy(), np.stack(rows["vec"].to_numpy())
                    if same:
                        names, ids, pos, raw = (np.concatenate([a, b]) for a, b in zip(old, (names, ids, pos, raw), strict=True))
                    unit = _unit(pd.Series(list(raw)))
                elif where == (g, block):
                    for at in range(0, len(rows), 256):
                        part = rows.iloc[at : at + 256]
                        q = np.stack(part["vec"].to_numpy())
                        near = _unit(part["vec"]) @ unit.T
                        p = part["pos"].to_numpy()[:, None]
                        near[(pos[None, :] < p - part["reach"].to_numpy()[:, None]) | (pos[None, :] >= p + part["reach"].to_numpy()[:, None])] = -np.inf
                        few = min(k, len(ids))
                        least = np.partition(near, len(ids) - few, axis=1)[:, len(ids) - few] - MARGIN  # the k-th best, less the rounding
                        for i, query in enumerate(part["entry"].to_numpy()):
                            t = np.flatnonzero((near[i] >= least[i]) & np.isfinite(near[i]))
                            if len(t):
                                s = _cosines(q[i], raw[t])
                                o = np.lexsort((ids[t], -s))[:k]
                                out.append(pd.DataFrame({"query": query, "entry": names[t][o], "id": ids[t][o], "score": s[o]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def _scan(queries: np.ndarray, names: np.ndarray, k: int):
    """The k best rows of a batch for each of a few queries (not the queries' own vectors)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                near = queries @ _unit(pdf["vec"]).T
                near[near > 1 - 1e-9] = -np.inf
                top = np.argsort(-near, axis=1)[:, :k]
                best = np.take_along_axis(near, top, 1)
                frame = pd.DataFrame({"query": np.repeat(names, top.shape[1]), "entry": pdf["entry"].to_numpy()[top.ravel()], "score": best.ravel()})
                yield frame[np.isfinite(frame["score"])]

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, bits: int = BITS,
           recall: float = RECALL, block: int = BLOCK, seed: int = 11, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query, rank, id, score``: the k nearest rows found for every row with ``is_query``, never its own id."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    id_type, result = rows.schema["id"].dataType.simpleString(), "query {0}, rank int, id {0}, score double"
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], result.format(id_type))
    rows = rows.where(F.size("vec") == sizes["n"]).withColumn("most", F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double")))))
    rows = rows.select("id", F.transform("vec", lambda x: x.cast("double") / F.col("most")).alias("vec"), "asks").dropDuplicates(["id", "vec"])

    by_vec = W.partitionBy("vec").orderBy("id")  # the limit below is taken before the shuffle as well
    few = rows.select("id", "vec").withColumn("nth", F.row_number().over(by_vec)).where(F.col("nth") <= k + 1)
    entry = few.groupBy("vec").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"))
    entry, asked = (checkpointed(x.withColumn("entry", F.monotonically_increasing_id())) for x in (entry, rows.where("asks").select("id", "vec")))

    sample = np.stack(_fit_rows(entry))
    rng = np.random.default_rng(seed)
    d = min(dimensions, sizes["n"])
    directions = [np.linalg.qr(rng.standard_normal((sizes["n"], d)))[0] for _ in range(orderings)]
    flat = [_unit(pd.Series(list(sample))) @ x for x in directions]
    middle, spread = np.stack([f.mean(axis=0) for f in flat]), np.stack([f.std(axis=0) + 1e-12 for f in flat])
    shift = rng.uniform(0, 1, (orderings, d))
    both = entry.select("entry", "id", "vec", F.lit(0).alias("kind")).unionByName(asked.select("entry", "id", "vec", F.lit(1).alias("kind")))
    keyed = both.mapInPandas(_keys(np.stack(directions), middle, spread, shift, bits), f"ordering int, key long, entry long, id {id_type}, kind int")
    line = ["ordering", "key", "kind", "id", "entry"]
    spaced = keyed.repartitionByRange(*line).sortWithinPartitions(*line).mapInPandas(_numbered, "ordering int, entry long, kind int, part int, within long")
    spaced = checkpointed(spaced)
    parts = spaced.groupBy("ordering", "part").agg(F.sum((F.col("kind") == 0).cast("long")).alias("n"))
    offset = parts.select("ordering", "part", (F.sum("n").over(W.partitionBy("ordering").orderBy("part")) - F.col("n")).alias("offset"))
    placed = spaced.join(offset, ["ordering", "part"]).select("ordering", "entry", "kind", (F.col("offset") + F.col("within")).alias("pos"))

    reach = _fitted_reach(entry, asked, placed, k, recall)
    kept = placed.where("kind = 0").join(entry.select("entry", "id", "vec"), "entry").select(
        "ordering", F.floor(F.col("pos") / block).alias("block"), F.lit(0).alias("kind"), "entry", "id", "pos", F.lit(0).cast("long").alias("reach"), "vec")
    touched = F.sequence(F.floor(F.greatest(F.col("pos") - reach, F.lit(0)) / block), F.floor((F.col("pos") + reach - 1) / block))
    asking = placed.where("kind = 1").join(asked, "entry").select(
        "ordering", F.explode(touched).alias("block"), F.lit(1).alias("kind"), "entry", "id", "pos", F.lit(reach).cast("long").alias("reach"), "vec")
    dealt = kept.unionByName(asking).repartition("ordering", "block").sortWithinPartitions("ordering", "block", "kind")
    found = dealt.mapInPandas(_best(k + 1), f"query long, entry long, id {id_type}, score double")

    found = found.groupBy("query", "entry").agg(F.max("score").alias("score"), F.min("id").alias("id"))
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id", "entry"))).where(F.col("rank") <= k + 1)
    each = found.join(entry.select("entry", "ids"), "entry").join(asked.select(F.col("entry").alias("query"), F.col("id").alias("asks")), "query")
    each = each.select("query", "asks", F.explode("ids").alias("id"), "score").where("id <> asks")
    top = W.partitionBy("query").orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select(F.col("asks").alias("query"), F.col("rank").cast("int").alias("rank"), "id", "score")


def _fit_rows(entry: DataFrame) -> list:
    """At most FIT_ROWS vectors, those with the smallest hash of their id."""
    return [r["vec"] for r in entry.select("id", "vec", "entry").orderBy(F.xxhash64("id"), "id", "entry").limit(FIT_ROWS).collect()]


def _fitted_reach(entry: DataFrame, asked: DataFrame, placed: DataFrame, k: int, recall: float) -> int:
    """The half window within which ``recall`` of the sampled queries' true neighbours lie in some ordering."""
    few = asked.orderBy(F.xxhash64("id"), "id", "entry").limit(FIT_QUERIES).toPandas()
    if not len(few):
        return 1
    near = entry.mapInPandas(_scan(_unit(few["vec"]), few["entry"].to_numpy(), k), "query long, entry long, score double")
    near = near.withColumn("nth", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "entry"))).where(F.col("nth") <= k)
    there = near.join(placed.where("kind = 0").select("entry", "ordering", "pos"), "entry")
    here = placed.where("kind = 1").select(F.col("entry").alias("query"), "ordering", F.col("pos").alias("own"))
    apart = there.join(here, ["query", "ordering"]).groupBy("query", "entry").agg(F.min(F.abs(F.col("pos") - F.col("own"))).alias("apart")).toPandas()  # at most k * FIT_QUERIES rows
    return 1 + int(np.quantile(apart["apart"], recall, method="higher")) if len(apart) else 1
