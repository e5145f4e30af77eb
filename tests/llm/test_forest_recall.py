"""The n-gram join at low thresholds."""

import numpy as np
import pytest

from terracube.llm import ngram_forest


def test_trees_are_added_where_length_one_misses_the_target(spark, monkeypatch):
    assert ngram_forest.trees_needed(ngram_forest.prefix_length()) == ngram_forest.TREES
    length = ngram_forest.prefix_length(threshold=0.3)
    trees = ngram_forest.trees_needed(length, threshold=0.3)
    assert length == 1 and 1 - 0.7**trees >= ngram_forest.RECALL > 1 - 0.7 ** (trees - 1)
    with pytest.raises(ValueError):
        ngram_forest.trees_needed(1, threshold=0.3, recall=1.0)
    asked, sketch = [], ngram_forest._sketch
    monkeypatch.setattr(ngram_forest, "_sketch", lambda *a: asked.append(a) or sketch(*a))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g h")], "doc_id long, text string")
    assert [r.n_links for r in ngram_forest.classes(docs, threshold=0.3).collect()] == [1, 1]
    assert asked[0][:2] == (ngram_forest.DEPTH, trees)


def shingle_sets(texts, n=5):
    out = []
    for t in texts:
        w = t.split()
        out.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))})
    return out


def brute_links(texts, threshold):
    sets = shingle_sets(texts)
    return [sum(i != j and len(a & b) >= threshold * len(a | b) - 1e-9 for j, b in enumerate(sets)) for i, a in enumerate(sets)]


def family(rng, sizes, words=120):
    """Groups of texts that share most of their words, at many similarities."""
    texts = []
    for g, size in enumerate(sizes):
        base = [f"g{g}w{k}" for k in range(words)]
        for _ in range(size):
            t = list(base)
            for k in rng.choice(words, rng.integers(0, 9), replace=False):
                t[k] = f"x{rng.integers(0, 10**9)}"
            texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_links_equal_all_pairs(spark, threshold):
    rng = np.random.default_rng(11)
    texts = family(rng, [1] * 40 + [2] * 40 + [5] * 10 + [80])
    order = rng.permutation(len(texts))
    docs = spark.createDataFrame([(int(i), texts[i]) for i in order], "doc_id long, text string").repartition(5)
    report = []
    got = {r.doc_id: r.n_links for r in ngram_forest.classes(docs, threshold=threshold, block=16, report=report).collect()}
    want = brute_links(texts, threshold)
    assert sum(got.values()) >= 0.998 * sum(want) > 0 and all(got[i] <= w for i, w in enumerate(want))
    assert [r["length"] for r in report] == ngram_forest.lengths(threshold) and report[0]["candidates"] > 0
    assert report[0]["linked"] > report[-1]["linked"]  # most are found by long prefixes


def test_texts_that_reached_the_recall_stop(spark):
    """Near copies of one page meet by the longest prefix; shorter ones do not expand them again."""
    rng, base = np.random.default_rng(12), [f"w{k}" for k in range(400)]
    texts = [" ".join([*base[:k], f"v{k}", *base[k + 1 :]]) for k in rng.permutation(400)[:300]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    report = []
    got = ngram_forest.classes(docs, block=8, report=report).collect()
    assert {r.n_links for r in got} == {299} and len({r.class_id for r in got}) == 1
    assert report[0]["candidates"] > 0 and [r["candidates"] for r in report[1:]] == [0] * (len(report) - 1)


def test_members_go_to_a_bounded_number_of_units():
    """However large a trie node is, a member is sent to at most ``BLOCKS`` units."""
    for n in (2, 500, 10**5, 10**9):
        block = max(ngram_forest.BLOCK, -(-n // ngram_forest.BLOCKS))
        assert -(-n // block) <= ngram_forest.BLOCKS
