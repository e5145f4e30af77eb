"""Corpus pipeline: raw documents to encoded training rows.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, in
the columns of ``documents`` (the last one adds ``ids``). ``run`` writes what a
stage returns as Parquet in the shared checkpoint folder and reads it again as the
next stage's input, so a lost executor never sends a run back further than a stage.

1. toxicity: the factorization machine learns from ``labels`` (rows of the held-out
   fifth excepted); documents it rejects go.
2. line dedup: lines on many sites go, but for their first occurrence, whatever share
   of a document they are; a document that is left without a word goes.
3. near duplicates: one document of each class stays.
4. mixing: documents are repeated (or left out) to the sources' target weights.
5. encoding: piece ids of every whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracube.llm import fm_toxicity, line_dedup, mixing, ngram_forest, suffix_pieces
from terracube.llm.common import table, words
from terracube.sources.io import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fm_toxicity.train(docs, table(spark, sf_dir, "labels").where(~fm_toxicity.held_out()))
    score = max(docs.columns, key=len) + "_score"  # longer than every column, so no clash
    return fm_toxicity.with_scores(docs, model, score_col=score).where(F.col(score) < 0.5).drop(score)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.cut_lines(docs).where((F.col("n_removed") == 0) | (F.size(words(F.col("text"))) > 0))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text")).cast("long")}
    return cut.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_forest.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_pieces.encode(docs)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup_stage), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources to target weights", mixing_stage), ("SentencePiece encoding", encoding)]

#: A learned model and piece merging have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    base = scratch_path(spark, "corpus-pipeline")  # removed when the session ends
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
