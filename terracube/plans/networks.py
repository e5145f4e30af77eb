"""Training (M5) and attribution (M10) of the feed-forward network.

Training is synchronous and data-parallel: for a step, each partition sends one row, the
sum of its examples' gradients; rows are added (in two levels if they are many); the driver
takes an Adam step. After the steps of an epoch it writes the weights, so a restarted run
goes on with the last finished epoch.
Batch statistics of the whole training split are used. They need no pass of their own:
the mean and variance of ``W x`` follow from the mean and covariance of the inputs, which
are gathered once. The validation error ends the training after ``patience`` epochs
without a gain, and the best epoch's weights are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.plans.models import ffn_forward, init_ffn, load_weights, save_weights, validation_flag
from terracube.plans.trees import KEYS, long_attributions
from terracube.schema import VALUE_COLS

SLOPE = 0.1
#: Partial sums that one task adds.
FAN_IN = 64
TRAINED = ["w1", "gamma", "beta", "w2", "b2"]


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for pdf in batches:
        if len(pdf):
            yield pdf, np.stack(pdf["xf"].to_numpy()).astype(float)


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the arrays ``g`` of all rows (a row per partition, as long as the model)."""
    if size < 50:
        return np.array(rows.agg(F.array(*[F.sum(F.col("g")[k]) for k in range(size)]).alias("g")).first()["g"])
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    vectors = rows.select("part", array_to_vector("g").alias("g"))
    if rows.rdd.getNumPartitions() > FAN_IN:  # two levels, so no task adds more than the square root
        vectors = vectors.groupBy(F.pmod(F.col("part"), F.lit(FAN_IN))).agg(Summarizer.sum(F.col("g")).alias("g"))
    return vectors.agg(Summarizer.sum(F.col("g")).alias("g")).first()["g"].toArray()


def _summed(examples: DataFrame, per_batch, size: int) -> np.ndarray:
    """``per_batch(pdf, x)`` summed over all examples; a partition sends one row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        total = np.zeros(size)
        for pdf, x in _batches(batches):
            total += per_batch(pdf, x)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "g": [total]})

    return _added(examples.mapInPandas(run, "part int, g array<double>"), size)


def input_moments(examples: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and covariance (population) of the inputs ``xf``."""
    s = _summed(examples, lambda pdf, x: np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()]), 1 + width + width * width)
    n = s[0]
    mean = s[1 : 1 + width] / n
    return int(n), mean, s[1 + width :].reshape(width, width) / n - np.outer(mean, mean)


def with_statistics(w: dict, mean: np.ndarray, cov: np.ndarray) -> dict:
    """The weights with the batch statistics that inputs of these moments have."""
    return w | {"mean": w["w1"] @ mean, "var": np.einsum("hi,ij,hj->h", w["w1"], cov, w["w1"])}


def kept_units(hashes: np.ndarray, epoch: int, hidden: int, dropout: float) -> np.ndarray:
    """Dropout mask (scaled) from a hash of row, epoch and unit: the same wherever a row is."""
    if not dropout:
        return np.ones((len(hashes), hidden))
    z = hashes.astype(np.int64).view(np.uint64)[:, None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(1 + epoch * hidden, 1 + (epoch + 1) * hidden, dtype=np.uint64)[None, :]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53
    return (u >= dropout) / (1 - dropout)


def batch_gradient(x: np.ndarray, y: np.ndarray, mask: np.ndarray, w: dict) -> dict:
    """Sums over a batch: smooth-L1 loss and what the gradients of all weights are made of."""
    scale = 1 / np.sqrt(w["var"] + w["eps"])
    unit = (x @ w["w1"].T - w["mean"]) * scale
    h = unit * w["gamma"] + w["beta"]
    a = np.where(h > 0, h, SLOPE * h) * mask
    e = (a @ w["w2"].T + w["b2"])[:, 0] - y
    g = np.clip(e, -1, 1)
    dh = g[:, None] * w["w2"][0] * mask * np.where(h > 0, 1.0, SLOPE)
    return {"loss": np.where(np.abs(e) < 1, 0.5 * e * e, np.abs(e) - 0.5).sum(), "w2": g @ a, "b2": g.sum(),
            "beta": dh.sum(axis=0), "gamma": (dh * unit).sum(axis=0), "outer": dh.T @ x}


def gradients(sums: dict, n: int, w: dict, mean: np.ndarray, cov: np.ndarray) -> dict:
    """Mean gradients of all weights; ``w1`` also moves the batch statistics."""
    scale = 1 / np.sqrt(w["var"] + w["eps"])
    through = w["gamma"] * scale
    w1 = through[:, None] * (sums["outer"] - np.outer(sums["beta"], mean))
    w1 -= (through * scale * sums["gamma"])[:, None] * (w["w1"] @ cov)  # by the variance
    return {"w1": w1 / n, "gamma": sums["gamma"] / n, "beta": sums["beta"] / n, "w2": sums["w2"][None, :] / n, "b2": np.array([sums["b2"] / n])}


def _packed(s: dict) -> np.ndarray:
    return np.concatenate([np.ravel(s[k]) for k in ("loss", "w2", "b2", "beta", "gamma", "outer")])


def _unpacked(v: np.ndarray, hidden: int, width: int) -> dict:
    cuts = np.cumsum([1, hidden, 1, hidden, hidden])
    loss, w2, b2, beta, gamma, outer = np.split(v, cuts)
    return {"loss": loss[0], "w2": w2, "b2": b2[0], "beta": beta, "gamma": gamma, "outer": outer.reshape(hidden, width)}


def _finished(spark, path: str) -> list[int]:
    """Epochs whose weights were written in whole."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch-*/_SUCCESS")
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(int(s.getPath().getParent().getName().split("-")[1]) for s in (fs.globStatus(where) or []))


def train_network(examples: DataFrame, path: str, epochs: int = 100, patience: int = 3, rate: float = 1e-2, dropout: float = 0.25, steps: int = 1,
                  seed: int = 42) -> tuple[dict, list[float]]:
    """M5/M6: the best epoch's weights (layout of ``init_ffn``) and the validation errors of the epochs,
    each of ``steps`` steps over the whole train split.

    ``path`` holds the weights and the optimiser's state of every finished epoch; a call with
    the same ``path`` goes on where the last one ended."""
    spark = examples.sparkSession
    data = validation_flag(examples.where(F.col("split") == "train")).select(F.flatten("x").alias("xf"), "y", F.xxhash64(F.lit(seed), *KEYS).alias("row"), "is_val")
    train, held = data.where("NOT is_val"), data.where("is_val")
    width = len(data.select("xf").first()[0])
    n, mean, cov = input_moments(train, width)
    w = init_ffn(width, seed)
    m, v = ({k: np.zeros_like(w[k]) for k in TRAINED} for _ in range(2))
    errors, best, begin = [], dict(w), 0
    if done := _finished(spark, path):
        state = load_weights(spark, f"{path}/epoch-{done[-1]:05d}")
        w, m, v, best = ({k: state[f"{p}{k}"] for k in TRAINED} for p in ("", "m_", "v_", "best_"))
        w, best, errors, begin = w | {"eps": 1e-5}, best | {"eps": 1e-5}, state["errors"].tolist(), done[-1] + 1
    for epoch in range(begin, epochs):
        if errors and len(errors) - 1 - int(np.argmin(errors)) >= patience:
            break
        for step in range(epoch * steps, (epoch + 1) * steps):
            g = _step_gradient(train, n, with_statistics(w, mean, cov), mean, cov, step, dropout)
            for k in TRAINED:
                m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** (step + 1))) / (np.sqrt(v[k] / (1 - 0.999 ** (step + 1))) + 1e-8)
        w = with_statistics(w, mean, cov)
        errors.append(_error(held, w))
        if errors[-1] <= min(errors):
            best = dict(w)
        save_weights(spark, {k: w[k] for k in TRAINED} | {f"{p}{k}": s[k] for p, s in (("m_", m), ("v_", v), ("best_", best)) for k in TRAINED} | {"errors": np.array(errors)}, f"{path}/epoch-{epoch:05d}")
    return with_statistics(best, mean, cov), errors


def _step_gradient(train: DataFrame, n: int, w: dict, mean: np.ndarray, cov: np.ndarray, step: int, dropout: float) -> dict:
    sent = train.sparkSession.sparkContext.broadcast(w)
    hidden, width = w["w1"].shape

    def sums(pdf: pd.DataFrame, x: np.ndarray) -> np.ndarray:
        return _packed(batch_gradient(x, pdf["y"].to_numpy(), kept_units(pdf["row"].to_numpy(), step, hidden, dropout), sent.value))

    return gradients(_unpacked(_summed(train, sums, 2 + 3 * hidden + hidden * width), hidden, width), n, w, mean, cov)


def _error(examples: DataFrame, w: dict) -> float:
    sent = examples.sparkSession.sparkContext.broadcast(w)
    n, se = _summed(examples, lambda pdf, x: np.array([len(x), ((ffn_forward(x, sent.value) - pdf["y"].to_numpy()) ** 2).sum()]), 2)
    return float(np.sqrt(se / n)) if n else 0.0


def integrated_gradients(x: np.ndarray, background: np.ndarray, w: dict) -> np.ndarray:
    """Gradients of the output along the straight line from each background row to each row of ``x``,
    integrated in closed form (a hidden unit changes its slope at most once on the line) and averaged
    over the background. A row's sum is its prediction minus the background's mean prediction."""
    scale = w["gamma"] / np.sqrt(w["var"] + w["eps"])
    unit = lambda r: (r @ w["w1"].T - w["mean"]) * scale + w["beta"]
    to, start = unit(x), unit(background)
    out = np.zeros(x.shape)
    for i in range(len(x)):
        step = to[i] - start
        with np.errstate(divide="ignore", invalid="ignore"):
            turn = np.clip(np.where(step != 0, -start / step, 1.0), 0, 1)  # where the unit crosses zero
        first, last = np.where(start > 0, 1.0, SLOPE), np.where(to[i] > 0, 1.0, SLOPE)
        first = np.where(start == 0, last, first)
        slope = np.where(first == last, first, turn * first + (1 - turn) * last)
        out[i] = ((x[i] - background) * ((slope * (w["w2"][0] * scale)) @ w["w1"])).mean(axis=0)
    return out


def network_attribution(examples: DataFrame, weights: dict, background: DataFrame, stats: DataFrame | None = None, features: Sequence[str] = VALUE_COLS) -> DataFrame:
    """M10 for the network: a row per example and input; per example the attributions sum to the
    prediction minus ``base``, the mean prediction of the ``background`` (a sample of fixed size)."""
    rows = np.array([list(r[0]) for r in background.select(F.flatten("x")).collect()], float)  # as many as were drawn
    sent = examples.sparkSession.sparkContext.broadcast((rows, weights, float(ffn_forward(rows, weights).mean())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, w, base = sent.value
        for pdf, x in _batches(batches):
            yield pdf.assign(base=base, phi=list(integrated_gradients(x, rows, w)))

    wide = examples.select(*KEYS, F.flatten("x").alias("xf")).mapInPandas(run, "lat double, lon double, gb_year int, xf array<double>, base double, phi array<double>")
    return long_attributions(wide, stats, features)
