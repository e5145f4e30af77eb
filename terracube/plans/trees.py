"""Boosted trees as tables: staged errors with patience (M6) and Shapley values.

A fitted ensemble is read back from its saved form as arrays of nodes. Its size is the
model's (trees x nodes), never the data's, so it is collected and broadcast; examples
stay in their partitions and pass through numpy in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracube.plans.models import prepare, validation_flag
from terracube.schema import VALUE_COLS

KEYS = ["lat", "lon", "gb_year"]


@dataclass
class Tree:
    """Nodes in arrays; ``feature`` is -1 at a leaf, rows at or below ``threshold`` go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(self.feature[at] >= 0)).size:
            n = at[inner]
            at[inner] = np.where(x[inner, self.feature[n]] <= self.threshold[n], self.left[n], self.right[n])
        return self.value[at]

    def paths(self, node: int = 0, held: dict | None = None) -> Iterator[tuple[float, dict]]:
        """Each leaf's value and its features: ``(low, high]`` that leads there, and the share of the
        training rows that follow the path at this feature's splits."""
        held = held or {}
        f = int(self.feature[node])
        if f < 0:
            yield float(self.value[node]), held
            return
        low, high, share = held.get(f, (-np.inf, np.inf, 1.0))
        for child, a, b in ((int(self.left[node]), low, min(high, self.threshold[node])), (int(self.right[node]), max(low, self.threshold[node]), high)):
            yield from self.paths(child, held | {f: (a, b, share * float(self.cover[child] / self.cover[node]))})


@dataclass
class Ensemble:
    trees: list[Tree]
    weights: list[float]

    def staged(self, x: np.ndarray) -> np.ndarray:
        """Predictions after each tree (rows x trees)."""
        return np.cumsum(np.stack([w * t.predict(x) for t, w in zip(self.trees, self.weights, strict=True)], axis=1), axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.staged(x)[:, -1]

    def first(self, n: int) -> "Ensemble":
        return Ensemble(self.trees[:n], self.weights[:n])

    def shapley(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """The mean prediction under the trees' own row shares, and each feature's Shapley value per row.

        A leaf's worth to a set of known features is its value, times 1 or 0 for a known feature that
        does or does not lead there, times its share for an unknown one. The sum over subsets of the other
        features of the path is a polynomial in their number, built one feature at a time."""
        base, out = 0.0, np.zeros(x.shape)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            for value, held in tree.paths():
                base += weight * value * float(np.prod([s for _, _, s in held.values()]))
                d = len(held)
                follows = {f: ((x[:, f] > a) & (x[:, f] <= b)).astype(float) for f, (a, b, _) in held.items()}
                sizes = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
                for f, (_, _, share) in held.items():
                    poly = [np.ones(len(x))]  # by how many of the others are known
                    for g, (_, _, other) in held.items():
                        if g != f:
                            poly = [other * (poly[k] if k < len(poly) else 0.0) + follows[g] * (poly[k - 1] if k else 0.0) for k in range(len(poly) + 1)]
                    out[:, f] += weight * value * (follows[f] - share) * sum(s * p for s, p in zip(sizes, poly, strict=True))
        return base, out


def load_ensemble(spark: SparkSession, path: str, weights: Sequence[float]) -> Ensemble:
    """The trees of a saved boosted model (its nodes, bounded by trees and depth)."""
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").toPandas()
    trees = []
    for _, t in rows.groupby("treeID", sort=True):
        leaf = t["leftChild"].to_numpy() < 0
        cut = np.array([np.nan if at_leaf else s["leftCategoriesOrThreshold"][0] for s, at_leaf in zip(t["split"], leaf, strict=True)])
        feature = np.array([-1 if at_leaf else s["featureIndex"] for s, at_leaf in zip(t["split"], leaf, strict=True)])
        trees.append(Tree(feature, cut, t["leftChild"].to_numpy(), t["rightChild"].to_numpy(), t["prediction"].to_numpy(), t["rawCount"].to_numpy(float)))
    return Ensemble(trees, list(weights))


def _inputs(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["xf"].to_numpy()).astype(float)


def staged_errors(examples: DataFrame, ensemble: Ensemble) -> list[float]:
    """Root mean squared error after each tree over ``examples``: a row per batch and stage is summed."""
    sent = examples.sparkSession.sparkContext.broadcast(ensemble)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                e = ((sent.value.staged(_inputs(pdf)) - pdf["y"].to_numpy()[:, None]) ** 2).sum(axis=0)
                yield pd.DataFrame({"stage": np.arange(len(e)), "se": e, "n": len(pdf)})

    sums = examples.select(F.flatten("x").alias("xf"), "y").mapInPandas(run, "stage int, se double, n long").groupBy("stage").agg(F.sum("se"), F.sum("n"))
    return [float(np.sqrt(se / n)) for _, se, n in sorted(tuple(r) for r in sums.collect())]  # a row per tree


def best_stage(errors: Sequence[float], patience: int = 3) -> int:
    """Number of trees kept: the best stage before ``patience`` stages in a row bring no gain."""
    best, waited = 0, 0
    for k, e in enumerate(errors):
        if k == 0 or e < errors[best]:
            best, waited = k, 0
        else:
            waited += 1
            if waited == patience:
                break
    return best + 1


def fit_boosted(examples: DataFrame, path: str, max_iter: int = 30, depth: int = 4, step: float = 0.1, patience: int = 3, seed: int = 42) -> tuple[Ensemble, list[float], object]:
    """M5/M6: trees fitted on nine tenths of the train split, validated on the rest after every tree;
    the ensemble ends at the best stage. Also returned: the staged errors and the whole fitted model."""
    data = validation_flag(examples.where(F.col("split") == "train"))
    train, _ = prepare(data.where(~F.col("is_val")))
    model = GBTRegressor(featuresCol="features", labelCol="y", maxIter=max_iter, maxDepth=depth, stepSize=step, seed=seed).fit(train)
    model.write().overwrite().save(path)
    whole = load_ensemble(examples.sparkSession, path, model.treeWeights)
    errors = staged_errors(data.where("is_val"), whole)
    return whole.first(best_stage(errors, patience)), errors, model


def score_trees(examples: DataFrame, ensemble: Ensemble) -> DataFrame:
    """M2 for trees: ``lat, lon, gb_year, split, y, prediction``."""
    sent = examples.sparkSession.sparkContext.broadcast(ensemble)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(prediction=sent.value.predict(_inputs(pdf))).drop(columns="xf")

    src = examples.select(*KEYS, "split", "y", F.flatten("x").alias("xf"))
    return src.mapInPandas(run, "lat double, lon double, gb_year int, split string, y double, prediction double")


def long_attributions(wide: DataFrame, stats: DataFrame | None, features: Sequence[str]) -> DataFrame:
    """``xf, phi`` per example to a row per input: month, variable, value (denormalised, P28, with ``stats``) and attribution."""
    n = len(features)
    j = wide.select(*KEYS, "base", F.posexplode(F.arrays_zip("xf", "phi")).alias("j", "p"))
    names = F.array(*[F.lit(f) for f in features])
    out = j.select(*KEYS, "base", (F.floor(F.col("j") / n) + 1).cast("int").alias("month"), F.element_at(names, F.col("j") % n + 1).alias("variable"),
                   F.col("p.xf").alias("value"), F.col("p.phi").alias("attribution"))
    if stats is None:
        return out
    s = F.broadcast(stats.select(F.col("variable").alias("__v"), "mean", "std"))  # a row per variable
    return out.join(s, F.col("variable") == F.col("__v"), "left").withColumn("value", F.col("value") * F.col("std") + F.col("mean")).drop("__v", "mean", "std")


def tree_attribution(examples: DataFrame, ensemble: Ensemble, stats: DataFrame | None = None, features: Sequence[str] = VALUE_COLS) -> DataFrame:
    """M10 for the ensemble: path-dependent Shapley values of the given examples, a row per input; per
    example they sum to the prediction minus ``base``."""
    sent = examples.sparkSession.sparkContext.broadcast(ensemble)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                base, phi = sent.value.shapley(_inputs(pdf))
                yield pdf.assign(base=base, phi=list(phi))

    src = examples.select(*KEYS, F.flatten("x").alias("xf"))
    wide = src.mapInPandas(run, "lat double, lon double, gb_year int, xf array<double>, base double, phi array<double>")
    return long_attributions(wide, stats, features)
