"""Ties among vectors of one direction."""

from pyspark.sql import functions as F

from terracube.llm import hilbert_ann


def test_multiples_of_a_vector_tie_by_id(spark):
    rows = [(100, [1.0, 2.0])] + [(i, [2.0**i, 2.0 ** (i + 1)]) for i in range(60, 0, -1)] + [(200 + i, [1.0 + i, 1.0]) for i in range(30)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = hilbert_ann.search(d, F.col("vec_id").isin(100, 30), recall=1.0).collect()
    assert sorted((r.query, r.rank, r.id) for r in got) == [(q, k, k) for q in (30, 100) for k in range(1, 6)]


def test_ids_that_repeat_with_other_vectors(spark):
    rows = [(50, [1.0, 0.0, 0.0]), (1, [0.9, 0.1, 0.0]), (1, [-0.2, 1.0, 0.0]), (2, [-0.2, 1.0, 0.0]), (3, [0.5, 0.5, 0.1]), (4, [0.0, 0.0, 1.0]), (50, [0.0, 1.0, 0.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hilbert_ann.search(d, F.col("vec_id") == 50, recall=1.0).collect()

    def brute(q):
        cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return sorted((-cos(q, v), i) for i, v in rows if i != 50)[:5]

    assert len(got) == 10
    found = sorted((r.rank, r.id, round(r.score, 9)) for r in got)
    assert found == sorted((k + 1, i, round(-s + 0.0, 9)) for q in (rows[0][1], rows[6][1]) for k, (s, i) in enumerate(brute(q)))


def test_other_multiples_keep_all_ranks(spark):
    rows = [(k, [0.1 * k, 0.2 * k, 0.3 * k]) for k in range(1, 60)] + [(100 + k, [1.0, float(k), -1.0]) for k in range(20)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = hilbert_ann.search(d, F.col("vec_id") == 7, recall=1.0).collect()
    assert len(got) == 5 and all(r.id < 60 and 1 - 1e-12 <= r.score <= 1 for r in got)
