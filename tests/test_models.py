"""Models: M1 against numpy least squares, M8 closed form, M10 additivity."""

import numpy as np
from pyspark.sql import functions as F

from terracube.plans import models as ML


def test_rnn_cell_closed_form():
    # batch 32, one step, hidden 124, 6 features, all inputs/weights/biases 1, zero state
    hidden, n_in = 124, 6
    w = {f"W{g}": np.ones((hidden, n_in + hidden)) for g in "fuco"}
    w.update({f"b{g}": np.ones(hidden) for g in "fuco"})
    x = np.ones((32, n_in))
    h, c = ML.rnn_cell(x, np.zeros((32, hidden)), np.zeros((32, hidden)), w)
    s7 = 1 / (1 + np.exp(-7.0))
    assert np.allclose(c, s7 * np.tanh(7.0))
    assert np.allclose(h, s7 * np.tanh(s7 * np.tanh(7.0)))


def test_linear_matches_lstsq(spark):
    from terracube.queries import _examples
    ex, _ = _examples(spark, "/root/testdata/sf0.01")
    data, feats = ML.prepare(ex)
    train = data.where(F.col("split") == "train")
    model = ML.fit_linear(train)
    pdf = train.select("features", "y").toPandas()
    X = np.stack([v.toArray() for v in pdf["features"]])
    X1 = np.hstack([X, np.ones((X.shape[0], 1))])
    beta, *_ = np.linalg.lstsq(X1, pdf["y"].to_numpy(), rcond=None)
    pred_np = X1 @ beta
    pred_sp = np.array([r.prediction for r in model.transform(train).select("prediction").collect()])
    assert np.sqrt(np.mean((pred_np - pred_sp) ** 2)) < 1e-4


def test_linear_attribution_additive(spark):
    """For a linear model, sum_j attribution_j = prediction - mean prediction
    over the background, so (sum of attributions - prediction) is the same
    constant for every test example."""
    from terracube.queries import _examples
    ex, _ = _examples(spark, "/root/testdata/sf0.01")
    att = ML.linear_attribution(ex, None, k_background=200)
    sums = att.groupBy("lat", "lon", "gb_year").agg(F.sum("attribution").alias("s"))
    preds, _, _ = ML.linear_fit_score(ex)
    j = sums.join(preds.where("split = 'test'"), ["lat", "lon", "gb_year"])
    diffs = np.array([r.s - r.prediction for r in j.collect()])
    assert len(diffs) == ex.where("split = 'test'").count() > 0
    assert np.ptp(diffs) < 1e-6 * max(1.0, np.abs(diffs).max())
    assert att.where(F.col("attribution").isNull()).count() == 0


def test_network_scores_shape(spark):
    from terracube.queries import _examples
    ex, _ = _examples(spark, "/root/testdata/sf0.001")
    for kind in ("ffn", "rnn"):
        out = ML.score_network(ex, kind, 7).collect()
        assert len(out) == ex.count()
        assert all(np.isfinite(r.prediction) for r in out)


def test_network_scores_match_local_forward(spark):
    from terracube.queries import _examples
    ex, _ = _examples(spark, "/root/testdata/sf0.001")
    rows = sorted(ex.select("lat", "lon", "gb_year", "x").collect())
    x = np.array([[list(m) for m in r.x] for r in rows], dtype=float)
    for kind, init, fwd in (("ffn", lambda: ML.init_ffn(77, 42), ML.ffn_forward),
                            ("rnn", lambda: ML.init_rnn(7, seed=42), ML.rnn_forward)):
        want = fwd(x, init())
        got = {(r.lat, r.lon, r.gb_year): r.prediction for r in ML.score_network(ex, kind, 7).collect()}
        have = np.array([got[(r.lat, r.lon, r.gb_year)] for r in rows])
        assert np.allclose(have, want, rtol=1e-9, atol=1e-12)
