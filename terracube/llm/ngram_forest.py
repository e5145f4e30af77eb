"""N-gram Jaccard join by a MinHash LSH forest.

Texts are sets of five-word shingles. A text has a path of ``DEPTH`` MinHash values in each
tree. Per tree the paths are sorted (ranges dealt so that no trie node at the shortest length
is divided), so texts that share a prefix stand together, and one sorted table serves every
prefix length: the trie nodes of a length are its runs.

Matching begins with whole paths and halves the prefix in rounds (``lengths``). A round compares
the pairs of a trie node that met in no longer one, where at least one text is still searching.
A text stops searching once its measured recall reaches the target: a neighbour of similarity
s meets it at length m in some tree with probability p = 1 - (1 - s^m)^trees, so each verified
neighbour stands for 1 / p, and the share of those found is known. Copies of a page stop after
the first round; a text that has found nothing goes down to the shortest length, at which a
pair at the threshold itself is met with the target probability (``prefix_length``; trees are
added where not even length 1 reaches it, ``trees_needed``).

Candidates are verified exactly on their shingles. Equal word sequences are one node from the
start, so a text found a million times is matched once. A trie node is compared block against
block: beyond ``BLOCK`` members it is split by a hash into at most ``BLOCKS`` blocks, every pair
of blocks is a unit of its own, so a member is sent to ``BLOCKS`` units at most, and units
compare their members in parts of bounded size. A pair is counted only in the first tree in
which it meets. Units send back a row per linked node (its number of links and a local root),
never the pairs. No trie node is capped.

Defined results: a word is a run without space, \\t-\\r; texts of one to four words
are one shingle; null and blank texts take no part (class of their own, no links);
rows that repeat a text are copies of one node; classes are connected components
and are named by their smallest id (null first); an empty table gives an empty
result; clashing column names are kept apart.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.llm.common import checkpointed, packed
from terracube.llm.components import components

WORDS = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
RECALL = 0.999
BLOCK, BLOCKS = 512, 32
#: Word hashes that a worker keeps before it starts anew.
KEPT_WORDS = 200_000


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold is found with probability ``recall``."""
    m = depth
    while m > 1 and 1 - (1 - threshold**m) ** trees < recall:
        m -= 1
    return m


def trees_needed(length: int, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """``trees``, or as many more as a pair at the threshold needs to be found with probability ``recall``."""
    meet = threshold**length
    if 1 - (1 - meet) ** trees >= recall:
        return trees
    if meet <= 0 or recall >= 1:
        raise ValueError(f"no number of trees finds pairs at {threshold} with probability {recall}")
    return max(trees, math.ceil(math.log(1 - recall) / math.log1p(-meet)))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(words: list[bytes], hashes: dict, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out ^= out >> np.uint64(29)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[i : len(h) - n + 1 + i]
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, count, dtype=np.uint64)


def lengths(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> list[int]:
    """The prefix lengths of the rounds: halved from the whole path on, down to the shortest one needed."""
    last, out = prefix_length(threshold, trees, depth, recall), []
    while depth > last:
        out.append(depth)
        depth //= 2
    return [*out, last]


def tree_paths(sh: np.ndarray, mult: np.ndarray, add: np.ndarray) -> bytes:
    """The upper 32 bits of each MinHash value, tree after tree, in big-endian order (so that bytes sort as values)."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(sh), 4096):
        part = sh[at : at + 4096]
        for k in range(0, len(mult), 16):
            low[k : k + 16] = np.minimum(low[k : k + 16], (part[None, :] * mult[k : k + 16, None] + add[k : k + 16, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(">u4").tobytes()


def _sketch(depth: int, trees: int, words: int):
    @F.pandas_udf("key binary, paths binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        mult, add = _permutations(trees * depth)
        for texts in batches:
            keys, paths = [], []
            for text in texts:
                w = text.encode("utf-8", "surrogatepass").split() if text else []
                keys.append(hashlib.md5(b" ".join(w)).digest() if w else None)
                paths.append(tree_paths(shingles(w, hashes, words), mult, add) if w else None)
            yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "paths": pd.Series(paths, dtype=object)})

    return run


def _runs(length: int):
    """Of sorted paths the trie nodes of a length that hold several: ``tree, bucket, key``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, waiting = None, None  # the run that is open, and its first row while it has only that
        for pdf in batches:
            out = []
            for tree, path, key in zip(pdf["tree"].tolist(), pdf["path"].tolist(), pdf["key"].tolist(), strict=True):
                node = (tree, path[: 4 * length])
                if node != last:
                    last, waiting = node, key
                    bucket = np.int64(xxhash.xxh3_64_intdigest(node[1], seed=tree) - 2**63).item()
                    continue
                if waiting is not None:
                    out.append((tree, bucket, waiting))
                    waiting = None
                out.append((tree, bucket, key))
            if out:
                yield pd.DataFrame(out, columns=["tree", "bucket", "key"])

    return run


def whole_groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of complete groups from batches sorted by ``by``, with the groups' starts."""
    kept = None
    for pdf in batches:
        pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        new = np.flatnonzero((pdf[by].to_numpy()[1:] != pdf[by].to_numpy()[:-1]).any(axis=1)) + 1
        if not len(new):
            kept = pdf
            continue
        kept = pdf.iloc[new[-1] :].reset_index(drop=True)
        yield pdf.iloc[: new[-1]], np.concatenate([[0], new])
    if kept is not None and len(kept):
        yield kept, np.array([0, len(kept)])


def _prefixes(paths: pd.Series, depth: int, length: int) -> np.ndarray:
    """A 64-bit hash of each tree's prefix (rows x trees)."""
    v = np.frombuffer(b"".join(paths), ">u4").reshape(len(paths), -1, depth)[:, :, :length].astype(np.uint64)
    out = v[:, :, 0].copy()
    for k in range(1, length):
        out ^= out >> np.uint64(29)
        out = out * np.uint64(0x9E3779B97F4A7C15) + v[:, :, k]
    return out


class _Meetings:
    """Which members of a unit meet in its tree for the first time in this round."""

    def __init__(self, pdf: pd.DataFrame, depth: int, length: int, longer: int | None):
        self.now = _prefixes(pdf["paths"], depth, length)
        self.before = _prefixes(pdf["paths"], depth, longer) if longer else None
        self.tree, self.side = pdf["tree"].to_numpy(), pdf["side"].to_numpy()
        self.split, self.searching = (pdf["low"] != pdf["high"]).to_numpy(), pdf["searching"].to_numpy()

    def pairs(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """rows x others; a member does not meet itself."""
        tree = self.tree[rows[0]]
        same = lambda v, t: v[rows, t][:, None] == v[others, t][None, :]
        here = same(self.now, tree) & (rows[:, None] != others[None, :]) & (self.searching[rows][:, None] | self.searching[others][None, :])
        if self.split[rows[0]]:
            here &= self.side[rows][:, None] != self.side[others][None, :]
        for t in range(tree):
            here &= ~same(self.now, t)
        if self.before is not None and here.any():
            for t in range(self.now.shape[1]):
                here &= ~same(self.before, t)
        return here

    def twos(self, a: np.ndarray) -> np.ndarray:
        """Of units with two members (``a`` and the next row), whether those meet."""
        same = self.now[a] == self.now[a + 1]
        ok = same.any(axis=1) & (same.argmax(axis=1) == self.tree[a]) & (~self.split[a] | (self.side[a] != self.side[a + 1])) & (self.searching[a] | self.searching[a + 1])
        return ok if self.before is None else ok & ~(self.before[a] == self.before[a + 1]).any(axis=1)


def _parts(a: int, b: int) -> list[np.ndarray]:
    return [np.arange(k, min(b, k + BLOCK)) for k in range(a, b, BLOCK)]


def _screen(depth: int, length: int, longer: int | None):
    """Of each unit, the members that meet another for the first time there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, cuts in whole_groups(batches, ["bucket", "low", "high"]):
            meet, keep = _Meetings(pdf, depth, length, longer), np.zeros(len(pdf), bool)
            sizes = np.diff(cuts)
            two = cuts[:-1][sizes == 2]
            if len(two):  # most units: all at once
                keep[two] = keep[two + 1] = meet.twos(two)
            for a, b in zip(cuts[:-1][sizes > 2], cuts[1:][sizes > 2], strict=True):
                parts = _parts(a, b)
                for i, p in enumerate(parts):
                    for q in parts[i:]:
                        m = meet.pairs(p, q)
                        keep[p] |= m.any(axis=1)
                        keep[q] |= m.any(axis=0)
            yield pdf[keep]

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of membership matrices in column chunks."""
    n = len(sets)
    if n == 2:
        out = np.zeros((2, 2), np.float32)
        out[0, 1] = out[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return out
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    total, step, out = int(shared.sum()), max(1, 8_000_000 // n), np.zeros((n, n), np.float32)
    for at in range(0, total, step):
        a, b = np.searchsorted(col, [at, at + step])
        m = np.zeros((n, min(step, total - at)), np.float32)
        m[owner[a:b], col[a:b] - at] = 1
        out += m @ m.T
    return out


def _verify(threshold: float, trees: int, depth: int, length: int, longer: int | None, rounds: list[int]):
    """Linked members of each unit: their links, a local root, and the links' ``1 / p`` at each round's length."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, cuts in whole_groups(batches, ["bucket", "low", "high"]):
            meet, sets = _Meetings(pdf, depth, length, longer), pdf["shingles"].to_numpy()
            size, copies, key = np.array([len(s) for s in sets], float), pdf["copies"].to_numpy(), pdf["key"].to_numpy()
            links, label, stand = np.zeros(len(pdf), np.int64), np.arange(len(pdf)), np.zeros((len(pdf), len(rounds)))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                parts = _parts(a, b)
                found = []
                for i, p in enumerate(parts):
                    for q in parts[i:]:
                        new = meet.pairs(p, q)
                        if not new.any():
                            continue
                        both = intersections([*sets[p], *sets[q]])[: len(p), len(p) :] if p is not q else intersections(list(sets[p]))
                        union = size[p][:, None] + size[q][None, :] - both
                        x, y = np.nonzero(new & (both >= threshold * union - 1e-6))
                        if p is q:
                            x, y = x[x < y], y[x < y]
                        if len(x):
                            found.append((p[x], q[y], both[x, y] / union[x, y]))
                if not found:
                    continue
                x, y, s = (np.concatenate(v) for v in zip(*found, strict=True))
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                inverse = 1 / (1 - (1 - np.minimum(s, 1.0)[:, None] ** np.array(rounds)[None, :]) ** trees)
                np.add.at(stand, x, copies[y][:, None] * inverse)
                np.add.at(stand, y, copies[x][:, None] * inverse)
                while True:  # smallest member of the local component
                    least = np.minimum(label[x], label[y])
                    if (label[x] == least).all() and (label[y] == least).all():
                        break
                    np.minimum.at(label, x, least)
                    np.minimum.at(label, y, least)
            hit = links > 0
            yield pd.DataFrame({"key": key[hit], "links": links[hit], "root": key[label[hit]], "stand": pd.Series(list(stand[hit]), dtype=object)})

    return run


def _shingled(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            sets = [shingles(t.encode("utf-8", "surrogatepass").split(), hashes, words).view(np.int64) for t in pdf["text"]]
            yield pd.DataFrame({"key": pdf["key"], "shingles": pd.Series(sets, dtype=object)})

    return run


def _round(trie: DataFrame, node: DataFrame, plain: DataFrame, stopped: DataFrame | None, threshold: float, words: int, trees: int, depth: int,
           rounds: list[int], k: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Candidate members and links of the k-th round."""
    length, longer = rounds[k], rounds[k - 1] if k else None
    member = trie.mapInPandas(_runs(length), "tree int, bucket long, key binary")
    if stopped is None:
        member = member.withColumn("searching", F.lit(True))
    else:
        member = member.join(stopped.withColumn("done", F.lit(True)), "key", "left").withColumn("searching", F.col("done").isNull()).drop("done")
    member = checkpointed(member)
    full = member.groupBy("bucket").agg(F.count("*").alias("n"), F.max("searching").alias("any")).where("n > 1 AND any")
    blocks = F.ceil(F.col("n") / F.greatest(F.lit(block), F.ceil(F.col("n") / BLOCKS)))
    member = member.join(full.select("bucket", blocks.alias("blocks")), "bucket").join(node.select("key", "paths"), "key")
    member = member.withColumn("side", F.pmod(F.xxhash64("key"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    unit = member.select("bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "tree", "side", "key", "paths", "searching")
    by = ["bucket", "low", "high"]
    unit = unit.repartition(*by).sortWithinPartitions(*by)
    unit = checkpointed(unit.mapInPandas(_screen(depth, length, longer), unit.schema))

    need = unit.select("key").distinct().join(node.select("key", "rep", "copies"), "key")
    text = plain.join(need, plain["doc_id"].eqNullSafe(need["rep.doc_id"]) & (plain["th"] == need["rep.th"]))
    text = text.select("key", "text").dropDuplicates(["key"])
    shingled = text.mapInPandas(_shingled(words), "key binary, shingles array<long>")
    whole = unit.join(shingled, "key").join(node.select("key", "copies"), "key").repartition(*by).sortWithinPartitions(*by)
    linked = whole.mapInPandas(_verify(threshold, trees, depth, length, longer, rounds), "key binary, links long, root binary, stand array<double>")
    return unit, checkpointed(linked)


def classes(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES, depth: int = DEPTH,
            recall: float = RECALL, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", report: list | None = None) -> DataFrame:
    """``doc_id, th, key, class_id, class_key, keep, n_links, n_copies``: a row per document.

    ``n_links`` is the number of other documents at the threshold or above, copies
    included; ``keep`` marks the representative of the class (all rows that repeat
    its id and text carry the mark). ``report`` gets each round's prefix length, candidate
    members and linked members.
    """
    rounds = lengths(threshold, trees, depth, recall)
    trees = trees_needed(rounds[-1], threshold, trees, recall)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    sketch = checkpointed(plain.select("doc_id", "th", _sketch(depth, trees, words)("text").alias("s")).select("doc_id", "th", "s.*"))
    node = sketch.where("key is not null").groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.count("*").alias("copies"),
                                                              F.max("paths").alias("paths"))
    node = checkpointed(node)

    every = F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.substring("paths", t * (4 * depth) + 1, F.lit(4 * depth)).alias("path"))))
    trie = node.select("key", every.alias("p")).select("p.tree", "p.path", "key")
    trie = checkpointed(trie.repartitionByRange("tree", F.substring("path", 1, 4 * rounds[-1])).sortWithinPartitions("tree", "path"))
    linked, stopped = None, None
    for k, length in enumerate(rounds):
        unit, found = _round(trie, node, plain, stopped, threshold, words, trees, depth, rounds, k, block)
        if report is not None:
            report.append({"length": length, "candidates": unit.count(), "linked": found.count()})
        linked = found if linked is None else linked.unionByName(found)
        if k + 1 < len(rounds):
            measured = linked.groupBy("key").agg(F.sum("links").alias("links"), F.sum(F.col("stand")[k]).alias("stand"))
            stopped = checkpointed(measured.where(F.col("links") >= recall * F.col("stand")).select("key"))

    comp = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    comp = comp.join(linked.groupBy("key").agg(F.sum("links").alias("links")), "key")
    named = node.select("key", "rep", "copies").join(comp, "key", "left").select(
        "key", "rep", "copies", F.coalesce("root", "key").alias("class_key"), F.coalesce("links", F.lit(0)).alias("links"))
    named = checkpointed(named)
    lead = named.groupBy("class_key").agg(F.min("rep").alias("lead"))
    named = named.join(lead, "class_key").select("key", "class_key", "lead", "copies", "links")
    out = sketch.select("doc_id", "th", "key").join(named, "key", "left")
    alone = F.col("class_key").isNull()
    return out.select(
        "doc_id", "th", "key", F.when(alone, F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("class_id"), "class_key",
        (alone | F.struct("doc_id", "th").eqNullSafe(F.col("lead"))).alias("keep"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents in their own columns, one of each class and all without words."""
    gone = classes(docs, id_col=id_col, text_col=text_col, **options)
    stay = gone.where("keep").groupBy("doc_id", "th").agg(F.max(F.col("class_key").isNull()).alias("alone"), F.count(F.lit(1)).alias("times"))
    df = packed(docs, F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    df = df.join(stay, df["id"].eqNullSafe(stay["doc_id"]) & (df["hash"] == stay["th"])).select("row", "id", "hash", "alone", "times")
    again = ~F.col("alone") & (F.col("times") > 1)  # rows that repeat a representative's id and text
    once = df.where(~again).unionByName(df.where(again).dropDuplicates(["id", "hash"]))
    return once.select(*[F.col("row")[c].alias(c) for c in docs.columns])
