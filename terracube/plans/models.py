"""Model jobs (M1-M10) on the example frame.

Training is MLlib: ``LinearRegression`` with the normal-equation solver
builds the (features x features) Gram matrix in one distributed
aggregate, so its cost is one scan whatever the number of examples.  The
neural scorers (M7, M8) are Arrow-batched ``mapInPandas`` forward passes
with broadcast numpy weights; neural *training* is re-aimed to MLlib
gradient-boosted trees (M5/M6).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracube.operators.metrics import verify
from terracube.operators.windows import flatten_x, hide_features
from terracube.schema import VALUE_COLS, VEGETATION_LABELS


def feature_labels(features: Sequence[str] = VALUE_COLS, months: int = 11) -> list[str]:
    """Month-major labels ``{var}_{month}``; month 11 precedes the target."""
    return [f"{v}_{m}" for m in range(1, months + 1) for v in features]


def materialise(examples: DataFrame) -> DataFrame:
    """Reliable checkpoint of a model input in the shared checkpoint folder.

    Iterative fits scan their input several times; without this every pass
    would recompute scan -> clean -> windows -> arrays, and a lost executor
    mid-fit would rerun that lineage.  The example set is one row per
    pixel-year, far smaller than the cube it came from.
    """
    from terracube.session import cut_lineage
    return cut_lineage(examples)


def prepare(examples: DataFrame, hide_vegetation: bool = False,
            features: Sequence[str] = VALUE_COLS) -> tuple[DataFrame, list[str]]:
    """P25 + W9: optional vegetation hiding, then the flattened vector."""
    feats = list(features)
    if hide_vegetation:
        examples = hide_features(examples, feats, VEGETATION_LABELS)
        feats = [f for f in feats if f not in VEGETATION_LABELS]
    return flatten_x(examples, "x", "features"), feats


def fit_linear(train: DataFrame):
    """Ordinary least squares with intercept (kept, unlike the original).
    C10 is prepare (S6, P25, W9) -> fit -> score (M2) -> evaluate (A15)."""
    lr = LinearRegression(featuresCol="features", labelCol="y", predictionCol="prediction",
                          regParam=0.0, elasticNetParam=0.0, solver="normal")
    return lr.fit(train)


def score(model, df: DataFrame) -> DataFrame:
    """M2: keyed predictions ``(lat, lon, gb_year, y, prediction)``."""
    return model.transform(df).select("lat", "lon", "gb_year", "split", "y", "prediction")


def evaluate(preds: DataFrame) -> DataFrame:
    """RMSE (and the other metrics) per split."""
    return verify(preds, "y", "prediction", by=["split"])


def linear_fit_score(examples: DataFrame, hide_vegetation: bool = False) -> tuple[DataFrame, object, list[str]]:
    data, feats = prepare(examples, hide_vegetation)
    model = fit_linear(data.where(F.col("split") == "train"))
    return score(model, data), model, feats


def ablation(examples: DataFrame) -> DataFrame:
    """M4: the same fit with and without vegetation inputs."""
    out = None
    for hide in (False, True):
        preds, _, _ = linear_fit_score(examples, hide)
        m = evaluate(preds).withColumn("variant", F.lit("no_vegetation" if hide else "all_features"))
        out = m if out is None else out.unionByName(m)
    return out


def coefficients(model, feats: Sequence[str], spark) -> DataFrame:
    """M9: ``(feature, value)`` from the fitted coefficients.

    The coefficient vector has (features x 11) entries regardless of data
    size, so building the frame on the driver is bounded.
    """
    labels = feature_labels(feats)
    coef = model.coefficients.toArray().tolist()
    return spark.createDataFrame(list(zip(labels, [float(c) for c in coef])), "feature string, value double")


def top_k_abs(df: DataFrame, col: str = "value", k: int = 10) -> DataFrame:
    """The k largest absolute values (the limit is the feature)."""
    return df.orderBy(F.abs(F.col(col)).desc(), F.col("feature")).limit(k)


def validation_flag(df: DataFrame, keys: Sequence[str] = ("lat", "lon", "gb_year"),
                    buckets: int = 10) -> DataFrame:
    """Reproducible 1-in-``buckets`` validation split by key hash."""
    return df.withColumn("is_val", F.pmod(F.xxhash64(*keys), F.lit(buckets)) == 0)


def fit_gbt(train: DataFrame, seed: int = 42, max_iter: int = 50):
    """M5/M6: non-linear regressor with validation-based early stopping."""
    gbt = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="prediction",
                       maxIter=max_iter, maxDepth=4, stepSize=0.1, seed=seed,
                       validationIndicatorCol="is_val", validationTol=0.001)
    return gbt.fit(train)


def nonlinear_fit_score(examples: DataFrame, seed: int = 42) -> DataFrame:
    data, _ = prepare(examples)
    train = validation_flag(data.where(F.col("split") == "train"))
    model = fit_gbt(train, seed)
    return score(model, data)


def background_sample(df: DataFrame, keys: Sequence[str] = ("lat", "lon", "gb_year"), k: int = 500, seed: int = 42) -> DataFrame:
    """T5: exactly ``k`` rows drawn with replacement (none from an empty frame); ``keys`` name a row.

    Keys are numbered in the order of their seeded hash: sorted ranges, whose row counts
    give each range its first number. ``k`` seeded ordinals below the number of rows are
    joined to the numbers. Only keys are sorted; the ``k`` drawn keys then fetch their rows.
    The draw depends on keys and seed, not on the partitioning.
    """
    from terracube.session import cut_lineage
    line = ["__h", *keys]
    spread = df.select(*keys, F.xxhash64(F.lit(seed), *keys).alias("__h")).repartitionByRange(*line).sortWithinPartitions(*line)
    # the id is the partition's number and the row's place in it, fixed by the checkpoint
    placed = cut_lineage(spread.select(*keys, F.monotonically_increasing_id().alias("__m")))
    part, place = F.shiftright("__m", 33), F.col("__m").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))  # a row per partition
    first = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__first"))
    n = counts.agg(F.sum("__n")).scalar()
    draws = df.sparkSession.range(k).select(F.floor(F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(1 << 53)) / F.lit(2.0**53) * n).alias("__at"))
    numbered = placed.withColumn("__part", part).join(F.broadcast(first), "__part").withColumn("__at", F.col("__first") + place)
    chosen = numbered.join(F.broadcast(draws), "__at").select(*keys)  # k rows
    return df.join(F.broadcast(chosen), list(keys)).select(*df.columns)


def linear_attribution(examples: DataFrame, stats: DataFrame | None = None,
                       k_background: int = 500, seed: int = 42, model=None) -> DataFrame:
    """Linear SHAP ``coef_j * (x_j - mean_bg_j)`` in long form.

    Output ``(lat, lon, gb_year, month, variable, value, attribution)``
    with ``value`` denormalised (P28) when ``stats`` is given.  Per example
    the attributions sum to prediction - mean prediction over the background.
    """
    data, feats = prepare(examples)
    model = model or fit_linear(data.where(F.col("split") == "train"))
    nf = len(feats)
    coef = [float(c) for c in model.coefficients.toArray()]
    bg = background_sample(data.where(F.col("split") == "train").select("lat", "lon", "gb_year", "x"), k=k_background, seed=seed)
    flat = F.flatten(F.col("x"))
    bg_mean = bg.select(flat.alias("f")).select(F.posexplode("f").alias("j", "v")) \
                .groupBy("j").agg(F.avg("v").alias("mu"))
    test = data.where(F.col("split") == "test").select("lat", "lon", "gb_year", F.posexplode(flat).alias("j", "value"))
    coef_df = F.broadcast(data.sparkSession.createDataFrame(
        [(j, c, j // nf + 1, feats[j % nf]) for j, c in enumerate(coef)],
        "j int, coef double, month int, variable string"))
    j = test.join(coef_df, "j").join(F.broadcast(bg_mean), "j")
    out = j.select("lat", "lon", "gb_year", "month", "variable", "value",
                   (F.col("coef") * (F.col("value") - F.col("mu"))).alias("attribution"))
    if stats is not None:
        s = F.broadcast(stats.select(F.col("variable").alias("__v"), "mean", "std"))
        out = (out.join(s, F.col("variable") == F.col("__v"), "left")
                  .withColumn("value", F.col("value") * F.col("std") + F.col("mean"))
                  .drop("__v", "mean", "std"))
    return out


# ------------------------------------------------------------ neural scoring

def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-z))


def init_ffn(n_in: int, seed: int = 42) -> dict:
    """Kaiming-uniform dense weights (hidden = inputs), batchnorm identity."""
    rng = np.random.default_rng(seed)
    b1 = np.sqrt(6.0 / n_in)
    return {"w1": rng.uniform(-b1, b1, (n_in, n_in)), "gamma": np.ones(n_in), "beta": np.zeros(n_in),
            "mean": np.zeros(n_in), "var": np.ones(n_in), "eps": 1e-5,
            "w2": rng.uniform(-b1, b1, (1, n_in)), "b2": np.zeros(1)}


def ffn_forward(x: np.ndarray, w: dict) -> np.ndarray:
    """M7: flatten -> dense (no bias) -> batchnorm (eval) -> LeakyReLU(0.1) -> dense(1)."""
    h = x.reshape(x.shape[0], -1) @ w["w1"].T
    h = (h - w["mean"]) / np.sqrt(w["var"] + w["eps"]) * w["gamma"] + w["beta"]
    h = np.where(h > 0, h, 0.1 * h)
    return (h @ w["w2"].T + w["b2"])[:, 0]


def init_rnn(n_in: int, hidden: int = 128, dense: Sequence[int] = (256,), seed: int = 42) -> dict:
    """Gate weights uniform(+-sqrt(1/hidden)); dense kaiming-uniform, zero bias."""
    rng = np.random.default_rng(seed)
    k = np.sqrt(1.0 / hidden)
    w = {f"W{g}": rng.uniform(-k, k, (hidden, n_in + hidden)) for g in "fuco"}
    w.update({f"b{g}": rng.uniform(-k, k, hidden) for g in "fuco"})
    sizes = [hidden, *dense, 1]
    for i in range(1, len(sizes)):
        b = np.sqrt(6.0 / sizes[i - 1])
        w[f"D{i}"] = rng.uniform(-b, b, (sizes[i], sizes[i - 1]))
        w[f"d{i}"] = np.zeros(sizes[i])
    w["n_dense"] = len(sizes) - 1
    return w


def rnn_cell(x: np.ndarray, h: np.ndarray, c: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray]:
    """One step of the gated cell: forget, update, candidates, output gates,
    each a dense layer over ``[x, h]`` with one bias."""
    z = np.concatenate([x, h], axis=-1)
    f = _sigmoid(z @ w["Wf"].T + w["bf"])
    u = _sigmoid(z @ w["Wu"].T + w["bu"])
    cand = np.tanh(z @ w["Wc"].T + w["bc"])
    c2 = f * c + u * cand
    o = _sigmoid(z @ w["Wo"].T + w["bo"])
    return o * np.tanh(c2), c2


def rnn_forward(x: np.ndarray, w: dict) -> np.ndarray:
    """M8: cell over the steps, then the dense stack with no activation between."""
    n, hidden = x.shape[0], w["Wf"].shape[0]
    h, c = np.zeros((n, hidden)), np.zeros((n, hidden))
    for t in range(x.shape[1]):
        h, c = rnn_cell(x[:, t, :], h, c, w)
    out = h
    for i in range(1, w["n_dense"] + 1):
        out = out @ w[f"D{i}"].T + w[f"d{i}"]
    return out[:, 0]


def save_weights(spark, weights: dict, path: str) -> None:
    """S10 for the networks: one row per weight array, ``(name, shape, values)``."""
    rows = [(n, list(np.shape(a)), np.asarray(a, float).ravel().tolist()) for n, a in weights.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def load_weights(spark, path: str) -> dict:
    """The weight set that ``save_weights`` wrote (its size is the model's, not the data's)."""
    out = {r["name"]: np.array(r["values"]).reshape(r["shape"]) for r in spark.read.parquet(path).collect()}
    return {n: int(a) if n == "n_dense" else a for n, a in out.items()}


def normal_residual(preds: DataFrame, data: DataFrame) -> DataFrame:
    """Largest absolute entry of ``X'(y - prediction) / n`` on the train split, 0 for a
    least-squares fit (the constant feature included)."""
    j = data.select("lat", "lon", "gb_year", F.flatten("x").alias("f")).join(
        preds.where(F.col("split") == "train").select("lat", "lon", "gb_year", (F.col("y") - F.col("prediction")).alias("e")), ["lat", "lon", "gb_year"])
    each = j.select("e", F.posexplode(F.concat(F.array(F.lit(1.0)), "f")).alias("j", "x"))
    sums = each.groupBy("j").agg((F.sum(F.col("x") * F.col("e")) / F.count(F.lit(1))).alias("s"))
    return sums.agg(F.max(F.abs("s")).alias("residual"))


def score_network(examples: DataFrame, kind: str, n_features: int, seed: int = 42, weights: dict | None = None) -> DataFrame:
    """M7/M8 batch scoring: Arrow batches -> numpy forward -> predictions.

    ``weights`` is a trained set in the layout of ``init_ffn``/``init_rnn`` (for
    example from ``load_weights``); without one, seeded weights are made.  Weights
    are broadcast once per executor; each task scores its own partitions, so no
    row passes through the driver.
    """
    spark = examples.sparkSession
    if kind == "ffn":
        weights, fwd = weights or init_ffn(n_features * 11, seed), ffn_forward
    elif kind == "rnn":
        weights, fwd = weights or init_rnn(n_features, seed=seed), rnn_forward
    else:
        raise ValueError(kind)
    bw = spark.sparkContext.broadcast(weights)

    steps = 11

    def run(batches):
        import pandas as pd
        w = bw.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            # one flat array per row (flattened JVM-side) -> one reshape per batch
            x = np.concatenate(pdf["xf"].to_numpy()).reshape(len(pdf), steps, n_features)
            yield pd.DataFrame({"lat": pdf["lat"], "lon": pdf["lon"], "gb_year": pdf["gb_year"],
                                "y": pdf["y"], "prediction": fwd(x, w)})

    src = examples.select("lat", "lon", "gb_year", "y", F.flatten("x").alias("xf"))
    return src.mapInPandas(run, "lat double, lon double, gb_year int, y double, prediction double")
