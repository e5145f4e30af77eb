"""Hard negatives against a sort of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracube.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>, id string, score int"


def brute(rows, anchors, positives=5, negatives=5):
    rows = [(i, l, np.floor(256 * np.array(v, float)).astype(int)) for i, l, v in rows]
    out = []
    for i, label, v in (r for r in rows if r[0] in anchors):
        order = sorted((-int(v @ w), j, m) for j, m, w in rows if j != i)
        for s, j, _ in [x for x in order if x[2] == label][:positives]:
            fit = [x for x in order if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fit[:negatives])]
    return sorted(out)


def run(spark, rows, anchors, **options):
    d = spark.createDataFrame([(i, l, v, "x", 1) for i, l, v in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in hn.mine(d, F.col("vec_id").isin(list(anchors)), **options).collect())


def test_ties_and_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), int(rng.integers(0, 4)), (rng.integers(-2, 3, 6) / 4).tolist()) for i in rng.permutation(600)]
    anchors = {i for i, *_ in rows if i % 20 == 0}
    want = brute(rows, anchors)
    assert run(spark, rows, anchors) == want and len(want) > 200
    assert run(spark, rows, anchors, row_block=50, anchor_block=7) == want
    assert run(spark, rows, anchors, positives=2, negatives=3) == brute(rows, anchors, 2, 3)


def test_one_label_holds_most_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 50 == 1), rng.standard_normal(8).tolist()) for i in range(400)]
    anchors = {0, 51, 101, 399}
    assert run(spark, rows, anchors, row_block=64) == brute(rows, anchors)


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, 0, [1.0, 0.0]), (2, 0, [0.9, 0.1]), (3, 1, [0.8, 0.0]), (4, 1, [0.0, 0.0]), (5, 1, [0.875, 0.0]), (6, 2, [0.875, 0.5])]
    odd = [(7, None, [1.0, 0.0]), (8, 1, None), (9, 1, [nan, 0.0]), (10, 1, [inf, 0.0]), (11, 1, [None, 0.9]), (12, 1, [0.9]), (None, 1, [0.9, 0.0]), (3, 1, [0.8, 0.0])]
    assert run(spark, good + odd, {1, 2, 7, 8}) == brute(good, {1, 2})
    assert run(spark, good, set()) == [] and run(spark, [], {1}) == []


def test_exact_scores_of_large_components():
    a = np.array([[2.0**26 + 1, 1.0], [3.0, -(2.0**25)]])
    assert hn.scores(a, a).tolist() == [[(2**26 + 1) ** 2 + 1, 3 * (2**26 + 1) - 2**25], [3 * (2**26 + 1) - 2**25, 9 + 2**50]]
    with pytest.raises(ValueError):
        hn.scores(a * 2.0**10, a)
