"""Trees: Shapley values against all subsets, staged errors. Network: gradients, attribution, training."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracube.plans import models as ML
from terracube.plans import networks as NN
from terracube.plans import trees as TR
from terracube.sources import io as IO


def random_tree(rng, features, depth):
    nodes = []

    def grow(d, cover):
        k = len(nodes)
        nodes.append(None)
        if d == 0 or cover < 2:
            nodes[k] = (-1, np.nan, -1, -1, rng.standard_normal(), cover)
            return k
        share = int(rng.integers(1, cover))
        f, t = int(rng.integers(0, features)), float(rng.standard_normal())
        left, right = grow(d - 1, share), grow(d - 1, cover - share)
        nodes[k] = (f, t, left, right, 0.0, cover)
        return k

    grow(depth, 100)
    return TR.Tree(*[np.array(c, dtype) for c, dtype in zip(zip(*nodes), (int, float, int, int, float, float))])


def expected(tree, x, known, node=0):
    """The prediction with unknown features averaged by the rows that went each way."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return expected(tree, x, known, left if x[f] <= tree.threshold[node] else right)
    a, b = tree.cover[left] / tree.cover[node], tree.cover[right] / tree.cover[node]
    return a * expected(tree, x, known, left) + b * expected(tree, x, known, right)


def test_shapley_values_equal_all_subsets():
    rng, p = np.random.default_rng(2), 4  # few features, so some stand twice on a path
    ensemble = TR.Ensemble([random_tree(rng, p, 3) for _ in range(3)], [1.0, 0.1, 0.5])
    x = rng.standard_normal((6, p))
    base, phi = ensemble.shapley(x)
    for i, row in enumerate(x):
        worth = lambda known: sum(w * expected(t, row, known) for t, w in zip(ensemble.trees, ensemble.weights))  # noqa: B023, E731
        assert base == pytest.approx(worth(()))
        for f in range(p):
            rest = [g for g in range(p) if g != f]
            want = sum(factorial(k) * factorial(p - 1 - k) / factorial(p) * (worth({*s, f}) - worth(set(s))) for k in range(p) for s in combinations(rest, k))
            assert phi[i, f] == pytest.approx(want, abs=1e-12)
        assert base + phi[i].sum() == pytest.approx(ensemble.predict(x)[i], abs=1e-12)


def test_best_stage_waits_and_goes_back():
    assert TR.best_stage([5, 4, 4.5, 4.2, 4.1, 1]) == 2  # three without a gain end it before the last
    assert TR.best_stage([5, 4, 4.5, 3, 3.5]) == 4
    assert TR.best_stage([1.0]) == 1
    assert TR.best_stage([3, 2, 2, 2, 0], patience=4) == 5


def examples(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 11, 2))
    y = np.abs(x[:, 3, 0]) + 0.5 * x[:, 10, 1] + 0.05 * rng.standard_normal(n)
    rows = [(float(i % 20), float(i // 20), 2000, "test" if i % 5 == 0 else "train", x[i].tolist(), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "lat double, lon double, gb_year int, split string, x array<array<double>>, y double").repartition(4).cache()


def test_ensemble_scores_as_the_model(spark):
    ex, path = examples(spark), IO.scratch_path(spark, "t-trees")
    kept, errors, model = TR.fit_boosted(ex, path, max_iter=8)
    whole = TR.load_ensemble(spark, path, model.treeWeights)
    data, _ = ML.prepare(ex, features=["a", "b"])
    want = {(r.lat, r.lon): r.prediction for r in ML.score(model, data).collect()}
    assert {(r.lat, r.lon): pytest.approx(r.prediction) for r in TR.score_trees(ex, whole).collect()} == want
    held = ML.validation_flag(ex.where("split = 'train'")).where("is_val").toPandas()
    x = np.array([np.concatenate([np.asarray(m) for m in v]) for v in held["x"]])
    assert errors == pytest.approx(np.sqrt(((whole.staged(x) - held["y"].to_numpy()[:, None]) ** 2).mean(axis=0)).tolist())
    assert len(kept.trees) == TR.best_stage(errors) and len(errors) == 8
    att = TR.tree_attribution(ex, whole, features=["a", "b"]).toPandas()
    assert att.groupby("variable")["month"].agg(["min", "max"]).to_numpy().tolist() == [[1, 11], [1, 11]]
    main = att["attribution"].abs().groupby([att["month"], att["variable"]]).mean().sort_values()
    assert set(main.index[-2:]) == {(4, "a"), (11, "b")}


def loss_of(x, y, mask, w, mean, cov):
    w = NN.with_statistics(w, mean, cov)
    return NN.batch_gradient(x, y, mask, w)["loss"] / len(x)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(5)
    x, y = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 5)) + 0.3, 2 * rng.standard_normal(60)
    w = ML.init_ffn(5, 3) | {"gamma": rng.uniform(0.5, 1.5, 5), "beta": rng.standard_normal(5), "b2": np.array([0.2])}
    mean, cov = x.mean(axis=0), np.cov(x.T, bias=True)
    mask = NN.kept_units(rng.integers(0, 2**62, 60), 3, 5, 0.25)
    assert 0.55 < (mask > 0).mean() < 0.95
    w = NN.with_statistics(w, mean, cov)
    assert np.allclose(w["mean"], (x @ w["w1"].T).mean(axis=0)) and np.allclose(w["var"], (x @ w["w1"].T).var(axis=0))
    g = NN.gradients(NN.batch_gradient(x, y, mask, w), len(x), w, mean, cov)
    for k in NN.TRAINED:
        for at in np.ndindex(w[k].shape):
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert g[k][at] == pytest.approx((loss_of(x, y, mask, up, mean, cov) - loss_of(x, y, mask, down, mean, cov)) / 2e-6, abs=2e-6), (k, at)


def test_integrated_gradients_are_complete():
    rng = np.random.default_rng(6)
    w = ML.init_ffn(6, 1) | {"gamma": rng.standard_normal(6), "beta": rng.standard_normal(6), "mean": rng.standard_normal(6), "var": rng.uniform(0.1, 2, 6), "b2": np.array([1.0])}
    x, b = rng.standard_normal((9, 6)), rng.standard_normal((20, 6))
    b[0] = x[0]
    phi = NN.integrated_gradients(x, b, w)
    assert np.allclose(phi.sum(axis=1), ML.ffn_forward(x, w) - ML.ffn_forward(b, w).mean(), atol=1e-12)
    one = NN.integrated_gradients(x[1:2], b[1:2], w)[0]  # against many small steps of the gradient
    t = (np.arange(20_000) + 0.5) / 20_000
    line = b[1] + t[:, None] * (x[1] - b[1])
    for j in range(6):
        e = np.eye(6)[j] * 1e-6
        assert one[j] == pytest.approx((x[1, j] - b[1, j]) * ((ML.ffn_forward(line + e, w) - ML.ffn_forward(line - e, w)) / 2e-6).mean(), abs=1e-3)


def test_training_learns_and_resumes(spark):
    ex = examples(spark)
    short, path = IO.scratch_path(spark, "t-net"), IO.scratch_path(spark, "t-net")
    w, errors = NN.train_network(ex, path, epochs=14, patience=14, rate=0.03, dropout=0.1)
    assert len(errors) == 14 and errors[-1] < 0.8 * errors[0]
    NN.train_network(ex, short, epochs=5, patience=14, rate=0.03, dropout=0.1)  # ends early, as a lost driver would
    again, more = NN.train_network(ex.repartition(7), short, epochs=14, patience=14, rate=0.03, dropout=0.1)
    assert more == pytest.approx(errors, rel=1e-6) and all(np.allclose(again[k], w[k], rtol=1e-5, atol=1e-8) for k in NN.TRAINED)
    test = ex.where("split = 'test'").toPandas()
    x = np.array([np.concatenate([np.asarray(m) for m in v]) for v in test["x"]])
    assert np.sqrt(((ML.ffn_forward(x, w) - test["y"]) ** 2).mean()) < test["y"].std()


def test_training_stops_with_patience(spark):
    w, errors = NN.train_network(examples(spark, 60, 3), IO.scratch_path(spark, "t-net"), epochs=30, patience=1, rate=0.5, dropout=0.0)
    assert len(errors) < 30 and errors[-1] > min(errors) and len(errors) - 1 - int(np.argmin(errors)) == 1
