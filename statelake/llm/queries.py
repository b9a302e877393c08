"""Registered queries of this package: the operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .block_labeller import extract
from .common import read, tokenizer_path
from .exact_dedup import exact_dedup
from .fuzzy_lines import dedup_lines
from .nbest import segmentations
from .outliers import robust_outliers
from .packing import pack
from .periodic_runs import digest, looped, periodic_runs
from .prefix_join import shingle_components
from .rank_profiles import languages
from .repeats import cut_repeats
from .token_alignment import alignment
from .token_counts import count_tokens
from .weak_labels import classify


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_outliers(read(spark, sf_dir, "documents"))


def op3_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op4_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = classify(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return answers.select("doc_id", F.col("_score").alias("score"), F.col("_kept").alias("kept"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), ids=False)


def op7_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents"))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(read(spark, sf_dir, "documents"))
    return lines.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_components(read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(periodic_runs(documents, text=looped(F.col("text"), F.col("doc_id"))).drop("text"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
    return counted.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_tokens").alias("n_tokens"), F.col("_over_limit").alias("over_limit"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_robust_outliers, op3_block_labeller, op4_weak_labels, op5_best_fit_packing, op6_nbest_segmentation, op7_rank_profiles, op8_fuzzy_lines, op9_ngram_jaccard, op10_suffix_array_dedup, op11_periodic_runs, op12_token_counts,
    op13_token_alignment)}

SQL = {
    "op1_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        WINDOW same AS (PARTITION BY t)""",
}
