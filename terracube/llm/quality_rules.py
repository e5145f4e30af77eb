"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Base statistics of each whole text, then cutoffs on ratios of them. A cutoff
rejects documents whose ratio lies above it. Labelled holdout documents decide
which cutoffs are safe: for a stratum and rule, candidates are tested from the
most lenient to the strictest, and each test asks with the exact binomial
distribution whether the share of good documents it rejects could still exceed
the allowed risk. A chain stops at its first failure (fixed-sequence testing),
and the error probability is divided by the number of chains (Bonferroni), so
with probability 1 - ``delta`` no stratum loses more than ``alpha`` of its good
documents to the rules together.

Defined results: a null or blank text has zero counts and fails the base rule;
a null stratum is a stratum of its own; a stratum without enough labels has no
cutoff and loses nothing beyond the base rule; several labels of one document
count as its lowest quality; repeated rows are judged alike; an empty table
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from terracube.llm.common import checkpointed, join_counted, null_key, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Candidate cutoffs per rule, lenient to strict; a ratio above the cutoff rejects.
CUTOFFS = {
    "symbol_ratio": (0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "dup_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4),
    "repeat_ratio": (0.25, 0.2, 0.15, 0.1),
    "mean_word_chars": (40.0, 30.0, 25.0, 20.0, 15.0),
}


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def base_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``id, stratum`` and the base counts of each whole text.

    Repeated windows are found per row: 64-bit hashes of the 8-word windows, and
    only texts with an equal pair sort them. No text is exploded or shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), null_key(F.col(stratum_col)).alias("stratum"), F.col(text_col).alias("text"))
    df = df.withColumn("words", words(F.col("text")))
    df = df.select(
        "doc_id", "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(_without(text, " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias("lines"),
        F.when(F.size("words") >= WINDOW,
               F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    df = df.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
               F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ranked"))
    near = lambda s, j: F.coalesce(F.get("ranked", j)["h"] == s["h"], F.lit(False))
    df = df.withColumn("starts", F.array_sort(F.transform(
        F.filter("ranked", lambda s, j: near(s, j - 1) | near(s, j + 1)), lambda s: s["i"])))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"])
    return df.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                     F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {"symbol_ratio": ratio("n_symbols", "word_chars"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"), "mean_word_chars": ratio("word_chars", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma for x >= 1: Stirling's series at x + 8, stepped back."""
    y, steps = x + 8.0, x
    for i in range(1, 8):
        steps = steps * (x + float(i))
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(steps)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k), X ~ Bin(n, p), for k below the mean; 1 at or above it.

    The largest term is taken in logs and the others follow by their ratios.
    Terms further than 12 sqrt(n) below k sum to less than exp(-288) (Hoeffding).
    """
    k, n = k.cast("double"), n.cast("double")
    log_top = (_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    steps = F.least(k, F.ceil(12 * F.sqrt(n)) + 50).cast("int")
    total = F.aggregate(
        F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, j: F.struct((a["t"] * (k - j + 1) * (1 - p) / ((n - k + j) * p)).alias("t"),
                              (a["s"] + a["t"] * (k - j + 1) * (1 - p) / ((n - k + j) * p)).alias("s")),
        lambda a: a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(log_top + F.log(total)))


def certified_cutoffs(stats: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``stratum, rule, cutoff``: the cutoff to apply for each stratum and rule that has a certified one.

    ``labels``: doc_id, quality (0 bad, 1 good). Of the certified cutoffs, the
    one with the largest excess of bad over good holdout documents rejected, and
    of those the most lenient, is chosen; without an excess there is none.
    ``alpha`` is split evenly over the rules.
    """
    risk = alpha / len(CUTOFFS)
    lab = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = stats.where(~base_failed()).join(lab, "doc_id")
    tests = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"), (v > c).cast("long").alias("hit"))
                      for r, v in ratios().items() for i, c in enumerate(CUTOFFS[r])])
    seen = (held.select("stratum", "quality", F.explode(tests).alias("t")).select("stratum", "quality", "t.*")
            .groupBy("stratum", "rule", "step", "cutoff")
            .agg(F.sum((F.col("quality") == 1).cast("long")).alias("n"),
                 F.sum(F.when(F.col("quality") == 1, F.col("hit")).otherwise(0)).alias("k"),
                 F.sum(F.when(F.col("quality") == 0, F.col("hit")).otherwise(0)).alias("caught")))
    chains = seen.select(F.count_distinct("stratum", "rule")).scalar()
    seen = seen.withColumn("p", binomial_cdf(F.col("k"), F.col("n"), risk)).withColumn("ok", F.col("p") * chains <= delta)
    chain = W.partitionBy("stratum", "rule").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    seen = seen.withColumn("certified", F.min("ok").over(chain)).where("certified")
    seen = seen.withColumn("gain", F.col("caught") - F.col("k"))
    best = F.max_by("cutoff", F.struct(F.col("gain"), -F.col("step")))
    return seen.groupBy("stratum", "rule").agg(best.alias("cutoff"), F.max("gain").alias("gain")).where("gain > 0").drop("gain")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, **columns) -> DataFrame:
    """Base statistics, ``base_failed``, the rules a document breaks and ``kept``.

    The texts are read once: the counts are checkpointed, the holdout uses them
    and the verdict is applied to them.
    """
    stats = checkpointed(base_stats(docs, **columns))
    cut = certified_cutoffs(stats, labels, alpha, delta)
    cut = checkpointed(cut.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))
    out = join_counted(stats, cut, "stratum")
    broken = F.filter(F.array(*[F.when(v > F.col("cutoffs")[r], F.lit(r)) for r, v in ratios().items()]), lambda x: x.isNotNull())
    out = out.withColumn("base_failed", base_failed()).withColumn("broken", broken)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
