"""Line dedup as the pipeline's second stage."""

import corpus_pipeline

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_pages_of_mostly_boilerplate_lose_it(spark):
    menu = "home | products | about us | contact | imprint | terms of use"
    rows = [(i, f"{menu}\nown text {i}", None, f"s{i}", 0) for i in range(12)] + [(20 + i, menu, None, f"s{i}", 0) for i in range(12)]
    out = corpus_pipeline.line_dedup_stage(spark, spark.createDataFrame(rows, DOC), "")
    assert {r.doc_id: r.text for r in out.collect()} == {0: rows[0][1]} | {i: f"own text {i}" for i in range(1, 12)}
