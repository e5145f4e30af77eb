"""Factorization machine: pairs whose terms say nothing alone, and the pair sum."""

import numpy as np
import pytest

from terracube.llm import fm_toxicity


def balanced(kind, n, seed=0):
    """Each of two terms stands in half of either label's documents; only both together tell."""
    rng, texts, labels = np.random.default_rng(seed), [], []
    for _ in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.integers(0, 150)}" for _ in range(20)] + ["alpha"] * a + ["beta"] * b
        texts.append(" ".join(rng.permutation(words)))
        labels.append({"one": a != b, "both or neither": a == b, "both": a and b}[kind])
    return texts, np.array(labels, float)


@pytest.mark.parametrize("kind", ["one", "both or neither", "both"])
def test_pairs_of_balanced_terms_are_learned(kind):
    texts, labels = balanced(kind, 6000)
    scorer = fm_toxicity.Scorer(fm_toxicity.fit(texts[:5000], labels[:5000]))
    got = np.array([scorer.score(t) >= 0.5 for t in texts[5000:]])
    assert (got == labels[5000:]).mean() > 0.95


def test_noise_terms_lose_their_factors():
    texts, labels = balanced("both", 5000, seed=3)
    assert len(fm_toxicity.fit(texts, labels)["terms"]) < 100  # of 152


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    model = {"bias": 0.3, "weights": rng.standard_normal(12), "factors": rng.standard_normal((12, fm_toxicity.FACTORS))}
    for size in (0, 1, 2, 7, 12):
        on = rng.permutation(12)[:size]
        pairs = sum(float(model["factors"][i] @ model["factors"][j]) for k, i in enumerate(on) for j in on[:k])
        assert fm_toxicity.raw_score(model, on) == pytest.approx(0.3 + model["weights"][on].sum() + pairs)
