"""From raw documents to packed training sequences: quality, lines, near duplicates, repeats, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.llm.common import read, tokenizer_path
from statelake.llm.fuzzy_lines import dedup_lines
from statelake.llm.packing import pack
from statelake.llm.prefix_join import one_of_each
from statelake.llm.repeats import without_repeats
from statelake.llm.weak_labels import classify
from statelake.session import shared_dir

WORD = r"[^\x20\x09-\x0D]"
# No stage but the last is SQL: a trained scorer, signatures, components and byte spans.
ORACLE_SQL = None


def _changed(before: DataFrame, after: DataFrame, removed: str) -> DataFrame:
    """The columns of ``before``; documents of which nothing is left go, ``n_chars`` follows the text."""
    left = after.where((F.col(removed) == 0) | F.col("text").rlike(WORD))
    if "n_chars" in before.columns:
        left = left.withColumn("n_chars", F.when(F.col(removed) == 0, F.col("n_chars")).otherwise(F.length("text")).cast(before.schema["n_chars"].dataType))
    return left.select(*before.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer accepts."""
    return classify(docs).where("_kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each family of near-equal lines the first stays."""
    return _changed(docs, dedup_lines(docs), "_n_removed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the smallest stays."""
    return one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the bytes of strings that occur earlier."""
    return _changed(docs, without_repeats(docs), "_n_removed")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
