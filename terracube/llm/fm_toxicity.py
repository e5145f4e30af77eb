"""Toxicity by a factorization machine over hashed terms.

A document's score is a logistic function of a bias, a weight per term and an
interaction per pair of terms, the dot product of the terms' factors. So a pair
can weigh more (or less) than its parts. Terms are lower-cased words hashed into
2^24 buckets; a term counts once per document.

Fitting uses at most ``max_rows`` labelled documents, those with the smallest
hash of their id, in one task. Every term found in ``MIN_DOCS`` of them has a weight
and factors from the start, so a pair can be learned whose terms say nothing alone.
FTRL with L1 keeps only weights that earn their place. The factors of a term without a
weight shrink as a group, a little every ``OFTEN`` documents, so they vanish for good
unless its pairs make them grow faster; a weight that appears later brings factors back.
A term is kept if its weight or its factors survive. The fitted terms are
bounded by that sample; scoring covers all documents in whole, in Arrow batches.

Only the text enters a score. Defined results: a null or empty text gets the
bias's score; documents with several labels count as toxic if one says so; null
ids and null labels are not learned from; ties in the hash go by id; without
labels every score is 0.5 of a zero model; repeated rows score alike; an empty
table gives an empty result; an input column named like an output column is
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 24
FACTORS = 4
#: Bound of the fitting sample (labelled documents), and documents that a term needs in it.
MAX_ROWS = 20_000
MIN_DOCS = 5
EPOCHS = 4
#: Size of the first factors (and of those of a term with a weight), their learning rate, and what
#: those of a term without a weight lose in length every so many documents.
FIRST, ALIVE, FACTOR_RATE, SHRINK, OFTEN = 0.01, 0.05, 0.05, 0.005, 250
KEPT_WORDS = 300_000

_TERMS = re.compile(r"\w+").findall


def hashed_terms(text: str | None) -> np.ndarray:
    """Distinct buckets of a text's terms, in order."""
    words = set(_TERMS(text.lower())) if text else ()
    h = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    return np.unique(h % np.uint64(BUCKETS)).astype(np.int64)


def raw_score(model: dict, on: np.ndarray) -> float:
    """The log-odds of a document from the places of its terms in the model."""
    v = model["factors"][on]
    return model["bias"] + float(model["weights"][on].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())


def fit(texts: list[str | None], labels: np.ndarray, alpha: float = 1.0, l1: float = 0.3, seed: int = 7) -> dict:
    """``bias``, ``terms`` (sorted buckets), ``weights`` and ``factors`` of the terms that are kept.

    Learns from four fifths of the sample. The L1 strength is ``l1`` times the
    square root of the number of toxic rows, the scale of a term's chance gradient.
    The bias is then moved so that 0.5 is the cut of best F1 on the other fifth.
    """
    rng = np.random.default_rng(seed)
    docs = [hashed_terms(t) for t in texts]
    mixed = rng.permutation(len(docs))
    learn, check = mixed[len(docs) // 5 :], mixed[: len(docs) // 5]
    l1 = l1 * float(np.sqrt(max(1.0, labels[learn].sum())))
    seen, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *[docs[i] for i in learn]]), return_counts=True)
    seen = seen[counts >= MIN_DOCS]
    docs = [np.searchsorted(seen, d[np.isin(d, seen, assume_unique=True)]) for d in docs]
    z, n, w = (np.zeros(len(seen)) for _ in range(3))
    v, nv = rng.normal(0, FIRST, (len(seen), FACTORS)), np.zeros((len(seen), FACTORS))
    share = labels[learn].mean() if len(learn) else 0.0
    bias, nb = float(np.log(share / (1 - share))) if 0 < share < 1 else 0.0, 0.0
    given = v * (ALIVE / FIRST)
    for step, i in enumerate(np.concatenate([rng.permutation(learn) for _ in range(EPOCHS)])):
        if step % OFTEN == 0:
            size = np.sqrt((v * v).sum(axis=1))
            v[w == 0] *= np.maximum(0, 1 - SHRINK / np.maximum(size[w == 0], 1e-12))[:, None]
            back = (w != 0) & (size < SHRINK)
            v[back] = given[back]
        x = docs[i]
        vx = v[x]
        s = vx.sum(axis=0)
        score = bias + w[x].sum() + 0.5 * float((s * s).sum() - (vx * vx).sum())
        g = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[i]
        nb += g * g
        bias -= alpha * g / (1 + np.sqrt(nb))
        if abs(g) < 0.01:
            continue
        old = n[x]
        n[x] = old + g * g
        z[x] += g - (np.sqrt(n[x]) - np.sqrt(old)) / alpha * w[x]
        zx = z[x]
        w[x] = np.where(np.abs(zx) > l1, -(zx - np.sign(zx) * l1) / ((1 + np.sqrt(n[x])) / alpha), 0.0)
        live = vx.any(axis=1)  # factors that have vanished stay away until the term has a weight
        if live.any():
            on, gv = x[live], g * (s - vx[live])
            nv[on] += gv * gv
            v[on] = vx[live] - FACTOR_RATE * gv / (1 + np.sqrt(nv[on]))
    keep = np.flatnonzero((w != 0) | (v != 0).any(axis=1))
    whole = {"bias": bias, "weights": w, "factors": v}
    got = np.array([raw_score(whole, docs[i]) for i in check])
    return {"bias": bias - best_cut(got, labels[check]), "terms": seen[keep], "weights": w[keep], "factors": v[keep]}


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut of best F1 half-way between neighbouring scores; 0 without both labels."""
    if not len(labels) or labels.min() == labels.max():
        return 0.0
    order = np.argsort(scores)
    s, y = scores[order], labels[order]
    hits, above = y.sum() - np.cumsum(y), len(y) - 1 - np.arange(len(y))  # above the cut behind each row
    f1 = np.where(np.diff(s, append=s[-1]) > 0, 2 * hits / (above + y.sum()), -1)
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if f1[k] > 0 else 0.0


class Scorer(dict):
    """Scores texts; the dictionary holds the model's place of each word seen, -1 for none."""

    def __init__(self, model: dict):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        bucket, terms = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % BUCKETS, self.model["terms"]
        k = int(np.searchsorted(terms, bucket))
        self[word] = k = k if k < len(terms) and terms[k] == bucket else -1
        return k

    def score(self, text: str | None) -> float:
        words = _TERMS(text.lower()) if text else ()
        on = np.unique(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        return float(1 / (1 + np.exp(-np.clip(raw_score(self.model, on[on >= 0]), -500, 500))))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Fit on at most ``max_rows`` labelled documents. The ids are chosen before any text moves."""
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    there = docs.select(F.col(id_col).alias("id")).distinct()
    chosen = lab.join(there, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # at most max_rows ids and labels: the texts stay where they are
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").dropDuplicates(["id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([pd.DataFrame({"id": [], "text": [], "label": []}), *batches])
        pdf = pdf.sort_values("id")
        m = fit(pdf["text"].tolist(), pdf["label"].to_numpy(float))
        yield pd.DataFrame({"term": [-1, *m["terms"]], "weight": [m["bias"], *m["weights"]],
                            "factors": [np.zeros(FACTORS), *m["factors"]]})

    # bounded: one task fits max_rows documents, and the driver gets their weighted terms
    rows = sample.repartition(1).mapInPandas(run, "term long, weight double, factors array<double>").toPandas().sort_values("term")
    if not len(rows):
        rows = pd.DataFrame({"term": [-1], "weight": [0.0], "factors": [np.zeros(FACTORS)]})
    return {"bias": float(rows["weight"].iloc[0]), "terms": rows["term"].to_numpy(np.int64)[1:], "weights": rows["weight"].to_numpy(float)[1:],
            "factors": np.stack(rows["factors"].tolist())[1:]}


def with_scores(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The documents with ``score`` (0 to 1) added."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return docs.withColumn(score_col, scored(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    """The fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def classified(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``held_out, score, predicted``, learned from the labels of rows not held out."""
    model = train(docs, labels.where(~held_out(id_col)), max_rows, id_col, text_col)
    df = with_scores(docs, model, text_col)
    return df.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
