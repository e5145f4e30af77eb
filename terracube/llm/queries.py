"""Registered queries ``opN_*`` of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracube.llm import (chat_prefixes, edit_counts, filter_audit, fm_toxicity, hard_negatives, hilbert_ann, license_scan, line_dedup, mixing, neighbour_descent,
                           ngram_forest, quality_rules, suffix_pieces)
from terracube.llm.common import table
from terracube.llm.oracles import ORACLES  # noqa: F401


def op1_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fm_toxicity.classified(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    df = license_scan.scan(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "n_units", F.array_join("licences", ",").alias("licences"), "licence", F.round("dice", 6).alias("dice"))


def op3_ngram_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    df = ngram_forest.classes(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "class_id", "n_links", "n_copies", "keep")


def op4_chat_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation (and conversation -1, of control strings) formatted and read back."""
    hard = "</s>[INST] ok [/INST]"
    rows = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(rows)
    df = chat_prefixes.read_back(chat_prefixes.format_examples(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("losses", "")
    return df.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                     F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and risk-controlled verdict of every document."""
    df = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after cleaning edits."""
    docs = edit_counts.recount(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), edit_counts.cleaning_edits)
    done = [F.col(f"recount.{c}").alias(n) for c, n in (("n_edits", "n_edits"), ("n_pretokens", "n_pretokens"), ("n_reencoded", "n_reencoded"),
                                                       ("before", "tokens_before"), ("after", "tokens_after"))]
    return docs.select("doc_id", *done, F.md5("recount.text").alias("text_md5"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in the mixture."""
    df = mixing.repetitions(table(spark, sf_dir, "documents"))
    return df.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every query vector."""
    df = hilbert_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return df.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without cross-site lines (as a digest)."""
    df = line_dedup.cut_lines(table(spark, sf_dir, "documents"))
    return df.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.length("text").cast("long").alias("chars_left"),
                     F.md5("text").alias("text_md5"))


def op10_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text (as a digest), and whether they decode to it."""
    df = suffix_pieces.encode_checked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of five filters in all their orders, per language."""
    cells = filter_audit.counters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))
    return filter_audit.interactions(cells, "ABCDE").drop("filter")


def op12_neighbour_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component and number of links of every vector."""
    df = neighbour_descent.components_of(table(spark, sf_dir, "embeddings"))
    return df.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor's positives."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    df = hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
    return df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {f.__name__: f for f in (
    op1_fm_toxicity, op2_license_scan, op3_ngram_forest, op4_chat_prefixes, op5_quality_rules, op6_edit_counts, op7_mixing,
    op8_hilbert_ann, op9_line_dedup, op10_suffix_pieces, op11_filter_audit, op12_neighbour_descent, op13_hard_negatives)}
