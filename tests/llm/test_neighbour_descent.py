"""NN-descent near-duplicates against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracube.llm import neighbour_descent as nd

SCHEMA = "vec_id long, embedding array<double>, node long, copies string, root int"


def brute(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if rows[i][0] is not None and v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    m = np.array([rows[i][1] for i in ok], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= threshold
    np.fill_diagonal(near, False)
    label = np.array([rows[i][0] for i in ok])
    while True:
        new = np.minimum(label, np.where(near, label[None, :], label.max() + 1).min(axis=1, initial=label.max() + 1))
        if (new == label).all():
            break
        label = new
    out = [(i, 0, i, True) for i, _ in rows]
    for k, i in enumerate(ok):
        out[i] = (rows[i][0], int(near[k].sum()), int(label[k]), bool(rows[i][0] == label[k]))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    d = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in nd.components_of(d, **options).select("id", "n_links", "component_id", "kept").collect()), key=repr)


def test_groups_chains_and_copies(spark):
    rng = np.random.default_rng(1)
    noise = [(int(i), rng.standard_normal(16).tolist()) for i in rng.permutation(400) + 1000]
    centre = rng.standard_normal(16)
    group = [(int(i), (centre + 0.03 * rng.standard_normal(16)).tolist()) for i in range(3000, 3150)]  # more than a list holds
    turn = np.linspace(0, 2.5, 40)  # neighbours in the chain are linked, its ends are not
    a, b = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
    chain = [(int(5000 - i), (np.cos(t) * a + np.sin(t) * b).tolist()) for i, t in enumerate(turn)]
    pair = rng.standard_normal(16)
    copies = [(7, pair.tolist()), (8, (2 * pair).tolist()), (9, (0.1 * pair).tolist()), (7, pair.tolist()), (7, (-pair).tolist())]
    inf, nan = float("inf"), float("nan")
    odd = [(20, None), (21, [0.0] * 16), (22, [nan] * 16), (23, [inf] + [1.0] * 15), (24, [None] + [1.0] * 15), (25, [1.0]), (26, []), (None, pair.tolist()), (None, None)]
    rows = noise + group + chain + copies + odd
    assert run(spark, rows, largest=20, block=64) == brute(rows)


def test_scattered_pairs_are_found(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((1500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(2000 + i, (v + 0.05 * rng.standard_normal(16)).tolist()) for i, v in enumerate(base[:300])]
    got, want = run(spark, rows), brute(rows)
    assert sum(n for _, n, *_ in got) >= 0.97 * sum(n for _, n, *_ in want) > 500
    assert all(n <= m for (_, n, *_), (_, m, *_) in zip(got, want, strict=True))  # none below the threshold


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, None)]) == [(5, 0, 5, True)]
    assert run(spark, [(5, [1.0, 2.0])]) == [(5, 0, 5, True)]
    assert run(spark, [(5, [1.0, 2.0]), (3, [2.0, 4.0])]) == [(3, 1, 3, True), (5, 1, 3, False)]


def test_too_low_a_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nd, "audited_recall", lambda *a: 0.5)
    monkeypatch.setattr(nd, "PASSES", 1)
    with pytest.raises(RuntimeError, match="recall"):
        run(spark, [(i, np.eye(16)[i % 16].tolist()) for i in range(20)], rounds=1)


def test_audit_measures_what_groups_miss(spark):
    rows = [(i, [1.0, i / 1000]) for i in range(10)]
    nodes = spark.createDataFrame(rows, "node long, vec array<double>")
    whole = spark.createDataFrame([(i, 0) for i in range(10)], "node long, root long")
    assert nd.audited_recall(nodes, whole, 0.95) == 1.0
    halves = whole.withColumn("root", F.floor(F.col("node") / 5))
    assert nd.audited_recall(nodes, halves, 0.95) == pytest.approx(4 / 9)
