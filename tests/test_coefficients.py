"""The coefficient table against numpy's least squares."""

import numpy as np
import pytest

from terracube import queries as Q
from terracube.plans import models as ML
from terracube.schema import VALUE_COLS


def test_fitted_top10_is_least_squares(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 11, len(VALUE_COLS))) + 3  # the inputs' means tell nothing of the coefficients
    y = x.reshape(400, -1) @ rng.standard_normal(11 * len(VALUE_COLS)) + rng.standard_normal(400)
    rows = [(0.0, float(i), 1995, "test" if i % 4 == 0 else "train", float(y[i]), x[i].tolist()) for i in range(400)]
    ex = spark.createDataFrame(rows, "lat double, lon double, gb_year int, split string, y double, x array<array<double>>")
    monkeypatch.setattr(Q, "_examples", lambda spark, sf_dir: (ex, None))
    train = np.arange(400) % 4 != 0
    a = np.column_stack([x.reshape(400, -1), np.ones(400)])[train]
    coef, _, rank, _ = np.linalg.lstsq(a, y[train], rcond=None)
    assert rank == a.shape[1]
    want = sorted(zip(ML.feature_labels(), coef[:-1], strict=True), key=lambda t: -abs(t[1]))[:10]
    got = [(r.feature, r.value) for r in Q.fitted_top10(spark, "").collect()]
    assert [f for f, _ in got] == [f for f, _ in want]
    assert [v for _, v in got] == pytest.approx([v for _, v in want], rel=1e-6)
