"""Near-duplicate vectors by NN-descent.

Every node keeps a list of its nearest nodes found so far. A round joins the
neighbours of each node with one another (neighbours of neighbours of the list's
owners, in both directions): whoever is nearer than the worst entry of a list enters
it. Only pairs with an entry that is new since the last round are tried, so rounds
get cheaper and end by themselves. The lists begin with random hyperplane orderings:
rows sorted by the signs of a few projections are joined with their neighbours in the
order. A list that is full of near-duplicates (saturated) is enlarged, twofold up to
``LARGEST``, as its owner may have more of them.

Whatever pair at the threshold is met in any join is kept as an edge, even if it is
pushed out of a list later; a join of ``PIECE`` members sends each member's link to
one root, never the pairs. The components of these edges are the groups. Recall is
audited: sampled nodes are compared with all nodes, and the share of their true
near-duplicates that lie in their group is measured; below ``RECALL`` more rounds
follow from new orderings, and a recall below ``LEAST_RECALL`` in the end is an error.
Vectors travel in half precision up to here (edges with a margin for it). Then the
members of each group are compared with one another in double precision, block by
block: every link inside a group is counted exactly and none below the threshold, and
groups fall apart into the components of true links.

Equal vectors (and multiples) are one node from the start. The neighbours of a hub and
the blocks of a large group are dealt to several tasks. Comparisons within a group of
different near copies grow with the square of its size, as exact numbers of links need;
they are spread over units, and a unit sends a row per member.

Defined results: rows with a null id, and vectors that are null, zero, hold null or
non-finite components, or have another length than most (of equal counts the longer)
are components of their own without links (the id names it, null for a null id);
repeated rows are copies of one node, and each counts the others as links; ids that
repeat with other vectors are other nodes; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terracube.llm.common import checkpointed, dealt_join
from terracube.llm.components import components
from terracube.llm.hilbert_ann import usable

THRESHOLD = 0.95
#: Entries of a list, at first and at most.
LIST, LARGEST = 10, 80
ORDERINGS = 4
#: Members joined at once, and candidates that each of them sends from one join.
PIECE, SENT = 32, 5
#: Rounds at most, and the share of new list entries below which they end.
ROUNDS, QUIET = 4, 0.2
RECALL, LEAST_RECALL, AUDITED, PASSES = 0.99, 0.9, 1_000, 4
#: Neighbours of a node that one task takes, and members of a block of a group.
HUB, BLOCK = 4_096, 1_024
#: Bound of the error of a cosine in half precision.
MARGIN = 2e-3

_PAIRS = "kind int, node long, nbr long, sim float"


def _units(vec: pd.Series) -> np.ndarray:
    m = np.stack(vec.to_numpy()).astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            half = _units(pdf["vec"]).astype(np.float16)
            yield pd.DataFrame({"node": pdf["node"], "half": [x.tobytes() for x in half]})


def _ordered(planes: np.ndarray):
    """Rows ``w, at`` of every node in each ordering: the signs of projections, then the first one's value."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            unit = _halves(pdf["half"]) if len(pdf) else None
            for g in range(len(planes) if len(pdf) else 0):
                flat = unit @ planes[g]
                code = ((flat[:, 1:] > 0) << np.arange(flat.shape[1] - 1)).sum(axis=1).astype(np.float64)
                yield pd.DataFrame({"w": g, "at": code + np.arctan(flat[:, 0]) / np.pi, "member": pdf["node"], "half": pdf["half"], "floor": np.float32(-1), "fresh": 1})

    return run


def _halves(half: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(half), np.float16).reshape(len(half), -1).astype(np.float32)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows with the starts of their pieces: at most ``PIECE`` neighbours of one ``w`` (and ``salt``) each."""
    kept = None
    for pdf in batches:
        pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        w = pdf[["w", "salt"]].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((w[1:] != w[:-1]).any(axis=1)) + 1]) if len(w) else np.zeros(0, int)
        last = starts[-1] if len(starts) else 0
        kept = pdf.iloc[last:].reset_index(drop=True)
        if last:
            yield pdf.iloc[:last], starts[:-1]
        if len(kept) > 8 * PIECE:  # of a long run all but the rest of the last piece
            whole = len(kept) // PIECE * PIECE
            yield kept.iloc[:whole], np.array([0])
            kept = kept.iloc[whole:].reset_index(drop=True)
    if kept is not None and len(kept):
        yield kept, np.array([0])


def _joined(threshold: float):
    """The local joins: each member's nearest others (kind 0) and its link to a root of near-duplicates (kind 1)."""
    near_from = threshold - MARGIN

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, starts in _pieces(batches):
            ends = np.append(starts[1:], len(pdf))
            cuts = np.concatenate([np.arange(a, b, PIECE) for a, b in zip(starts, ends, strict=True)])
            sizes = np.diff(np.append(cuts, len(pdf)))
            slot = np.arange(len(pdf)) - np.repeat(cuts, sizes)
            piece = np.repeat(np.arange(len(cuts)), sizes)
            half, node = _halves(pdf["half"]), pdf["member"].to_numpy()
            floor, fresh = pdf["floor"].to_numpy(), pdf["fresh"].to_numpy() > 0
            for a in range(0, len(cuts), 256):
                r = np.flatnonzero((piece >= a) & (piece < a + 256)) if len(cuts) > 256 else np.arange(len(pdf))
                p, s = piece[r] - a, slot[r]
                shape = (int(p.max()) + 1, PIECE)
                m, who = np.zeros((*shape, half.shape[1]), np.float32), np.full(shape, -1, np.int64)
                low, new, there = np.full(shape, 2, np.float32), np.zeros(shape, bool), np.zeros(shape, bool)
                m[p, s], who[p, s], low[p, s], new[p, s], there[p, s] = half[r], node[r], floor[r], fresh[r], True
                sim = m @ m.transpose(0, 2, 1)
                tried = there[:, :, None] & there[:, None, :] & (new[:, :, None] | new[:, None, :]) & (who[:, :, None] != who[:, None, :])
                sim[~tried] = -2
                top = np.argpartition(-sim, SENT, axis=2)[:, :, :SENT]
                best = np.take_along_axis(sim, top, 2)
                g, i, k = np.nonzero((best > low[:, :, None]) & (best > -2))
                out = [pd.DataFrame({"kind": np.int32(0), "node": who[g, i], "nbr": who[g, top[g, i, k]], "sim": best[g, i, k]})]
                near = sim >= near_from
                if near.any():
                    label = np.broadcast_to(np.arange(PIECE), shape).copy()
                    while True:  # smallest place that is linked
                        linked = np.minimum(label, np.where(near, label[:, None, :], PIECE).min(axis=2))
                        if (linked == label).all():
                            break
                        label = linked
                    g, i = np.nonzero(label != np.arange(PIECE))
                    out.append(pd.DataFrame({"kind": np.int32(1), "node": who[g, i], "nbr": who[g, label[g, i]], "sim": np.float32(1)}))
                yield pd.concat(out, ignore_index=True)

    return run


def _lists(known: DataFrame | None, found: DataFrame, threshold: float, size: int, largest: int) -> DataFrame:
    """The best ``k`` entries per node (``node, nbr, sim, fresh, k, floor``); saturated lists get twice the room."""
    fresh = found.where("kind = 0").select("node", "nbr", "sim", F.lit(1).alias("fresh"), F.lit(size).alias("k"))
    both = fresh if known is None else fresh.unionByName(known.select("node", "nbr", "sim", F.lit(0).alias("fresh"), "k"))
    both = both.repartition("node").groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.max("k").alias("k"))
    mine, order = W.partitionBy("node"), W.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    best = both.withColumns({"k": F.max("k").over(mine), "nth": F.row_number().over(order)}).where("nth <= k")
    best = best.withColumns({"n": F.count("*").over(mine), "worst": F.min("sim").over(mine)})
    k = F.when((F.col("n") >= F.col("k")) & (F.col("worst") >= threshold - MARGIN), F.least(2 * F.col("k"), F.lit(largest))).otherwise(F.col("k"))
    best = best.withColumn("k", k)
    return best.select("node", "nbr", "sim", "fresh", "k", F.when(F.col("n") < F.col("k"), F.lit(-1.0)).otherwise(F.col("worst")).cast("float").alias("floor"))


def _neighbourhoods(lists: DataFrame, halves: DataFrame, turn: int) -> DataFrame:
    """Members of every node's neighbourhood with their vectors, where something is new."""
    both = lists.select(F.col("node").alias("w"), F.col("nbr").alias("member"), "fresh").unionByName(lists.select(F.col("nbr").alias("w"), F.col("node").alias("member"), "fresh"))
    both = both.repartition("w").groupBy("w", "member").agg(F.max("fresh").alias("fresh"))
    mine = W.partitionBy("w")
    both = both.withColumns({"new": F.max("fresh").over(mine), "n": F.count("*").over(mine)}).where("new = 1 AND n > 1")
    at = F.xxhash64("member", F.lit(turn))  # other pieces in every round
    both = both.select("w", F.pmod(at, F.ceil(F.col("n") / HUB)).cast("int").alias("salt"), at.alias("at"), "member", "fresh")
    info = halves.join(lists.groupBy("node").agg(F.max("floor").alias("floor")), "node", "left").select(F.col("node").alias("member"), "half", F.coalesce("floor", F.lit(-1.0).cast("float")).alias("floor"))
    return both.join(info, "member").repartition("w", "salt").sortWithinPartitions("w", "salt", "at").select("w", "salt", "member", "half", "floor", "fresh")


def _audit(sample: np.ndarray, roots: np.ndarray, names: np.ndarray, threshold: float):
    """Per sampled node: its near-duplicates in a batch, and those of its group."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                near = sample @ _units(pdf["vec"]).T >= threshold
                near &= names[:, None] != pdf["node"].to_numpy()[None, :]
                same = near & (roots[:, None] == pdf["root"].to_numpy()[None, :])
                yield pd.DataFrame({"node": names, "true": near.sum(axis=1), "same": same.sum(axis=1)}).query("true > 0")

    return run


def audited_recall(nodes: DataFrame, grouped: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Mean share of the true near-duplicates of at most ``audited`` nodes that lie in the node's group."""
    rooted = nodes.join(grouped, "node", "left").select("node", "vec", F.coalesce("root", "node").alias("root"))
    few = rooted.orderBy(F.xxhash64("node"), "node").limit(audited).toPandas()  # bounded
    if not len(few):
        return 1.0
    scan = _audit(_units(few["vec"]), few["root"].to_numpy(), few["node"].to_numpy(), threshold)
    per = rooted.mapInPandas(scan, "node long, true long, same long").groupBy("node").agg((F.sum("same") / F.sum("true")).alias("share"))
    return float(per.agg(F.coalesce(F.avg("share"), F.lit(1.0))).first()[0])


def _verified(threshold: float):
    """Links and local roots of a unit's members (a block of a group, or two)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames, unit = [], None

        def done() -> Iterator[pd.DataFrame]:
            g = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame({"node": []})
            if len(g) < 2:
                return
            m, side, split = _units(g["vec"]), g["side"].to_numpy(), unit[1] != unit[2]
            label, links = np.arange(len(g)), np.zeros(len(g), np.int64)
            blocks = []
            for a in range(0, len(g), 512):
                near = m[a : a + 512] @ m.T >= threshold
                if split:
                    near &= side[a : a + 512, None] != side[None, :]
                near[np.arange(len(near)), np.arange(a, a + len(near))] = False
                links[a : a + 512] = near @ g["copies"].to_numpy()
                blocks.append(near)
            near = np.concatenate(blocks)
            while True:
                new = np.minimum(label, np.where(near, label[None, :], len(g)).min(axis=1))
                if (new == label).all():
                    break
                label = new
            hit = links > 0
            node = g["node"].to_numpy()
            yield pd.DataFrame({"node": node[hit], "links": links[hit], "near": node[label[hit]]})

        for pdf in batches:
            key = pdf[["root", "low", "high"]].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(pdf)] if len(pdf) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if tuple(key[a]) != unit:
                    yield from done()
                    frames, unit = [], tuple(key[a])
                frames.append(pdf.iloc[a:b])
        yield from done()

    return run


def _exact_links(nodes: DataFrame, grouped: DataFrame, threshold: float, block: int) -> DataFrame:
    """``node, links, near`` of the links inside the groups; several rows per node."""
    sizes = grouped.groupBy("root").agg(F.ceil(F.count("*") / block).alias("blocks"))
    member = dealt_join(grouped, sizes, "root", ["node"]).join(nodes.select("node", "vec", "copies"), "node")
    member = member.withColumn("side", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    unit = member.select("root", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "vec", "copies")
    by = ["root", "low", "high"]
    return unit.repartition(*by).sortWithinPartitions(*by).mapInPandas(_verified(threshold), "node long, links long, near long")


def _descent(halves: DataFrame, count: int, length: int, threshold: float, size: int, largest: int, orderings: int, rounds: int, seed: int,
             lists: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The neighbour lists after rounds from new orderings, and the edges met."""
    rng = np.random.default_rng(seed)
    depth = min(40, max(1, math.ceil(math.log2(max(2, count) / PIECE))) + 1)
    planes = rng.standard_normal((orderings, length, depth)).astype(np.float32)
    start = halves.mapInPandas(_ordered(planes), "w int, at double, member long, half binary, floor float, fresh int")
    start = start.repartitionByRange("w", "at", "member").sortWithinPartitions("w", "at", "member").withColumn("salt", F.lit(0))
    found = checkpointed(start.mapInPandas(_joined(threshold), _PAIRS))
    met = found.where("kind = 1").select(F.col("node").alias("a"), F.col("nbr").alias("b"))
    for turn in range(rounds):
        lists = checkpointed(_lists(lists, found, threshold, size, largest))
        if turn and lists.where("fresh = 1").count() < QUIET * size * count:
            break
        found = checkpointed(_neighbourhoods(lists, halves, seed + turn).mapInPandas(_joined(threshold), _PAIRS))
        met = met.unionByName(found.where("kind = 1").select(F.col("node").alias("a"), F.col("nbr").alias("b")))
    return lists, checkpointed(met.distinct())


def components_of(vectors: DataFrame, threshold: float = THRESHOLD, size: int = LIST, largest: int = LARGEST, orderings: int = ORDERINGS, rounds: int = ROUNDS,
                  recall: float = RECALL, block: int = BLOCK, seed: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, n_links, component_id, kept`` of every row: the other rows at the threshold or above, the
    smallest id reachable by links, and whether that is the row's own."""
    every = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    fits = F.col("id").isNotNull() & usable(F.col("vec"))
    sizes = every.where(fits).groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    fits = fits & (F.size("vec") == (sizes["n"] if sizes else 0))
    most = F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))
    every = every.withColumn("vec", F.when(fits, F.transform("vec", lambda x: x.cast("double")))).withColumn("most", most)
    every = every.withColumn("vec", F.transform("vec", lambda x: x / F.col("most")))
    keyed = every.select("id", "vec", F.when(F.col("vec").isNotNull(), _digest(F.col("vec"))).alias("key"))
    nodes = keyed.where("key is not null").groupBy("key").agg(F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    halves = checkpointed(nodes.select("node", "vec").mapInPandas(_packed, "node long, half binary"))
    count = halves.count()
    lists, edges, share = None, None, 0.0
    for turn in range(PASSES if count > 1 else 0):
        lists, met = _descent(halves, count, sizes["n"], threshold, size, largest, orderings, rounds, seed + 100 * turn, lists)
        edges = met if edges is None else edges.unionByName(met)
        grouped = checkpointed(components(edges))
        share = audited_recall(nodes, grouped, threshold)
        if share >= recall:
            break
    if count > 1:
        if share < min(recall, LEAST_RECALL):
            raise RuntimeError(f"recall {share:.3f} after {PASSES} passes; use more orderings, rounds or longer lists")
        links = checkpointed(_exact_links(nodes, grouped, threshold, block))
        final = components(links.select(F.col("node").alias("a"), F.col("near").alias("b"))).join(links.groupBy("node").agg(F.sum("links").alias("links")), "node")
        named = nodes.select("node", "key", "copies", "least").join(final, "node", "left")
    else:
        named = nodes.select("node", "key", "copies", "least", F.col("node").alias("root"), F.lit(0).cast("long").alias("links"))
    named = checkpointed(named.select("key", "copies", "least", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    lead = named.groupBy("root").agg(F.min("least").alias("component_id"))
    told = dealt_join(named, lead, "root", ["key"]).select("key", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    linked = dealt_join(keyed.where("key is not null").select("id", "key"), told, "key", ["id"]).select("id", "n_links", "component_id")
    alone = keyed.where("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _digest(vec: Column) -> Column:
    """128 bits of an array of doubles; -0.0 counts as 0.0."""
    plain = F.transform(vec, lambda x: x + 0.0)
    return F.struct(F.xxhash64(plain).alias("a"), F.xxhash64(F.lit("vector"), plain).alias("b"))
