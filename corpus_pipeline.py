"""Corpus preparation: quality classifier, language ID, n-gram Jaccard join, benchmark decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitflow.llm.common import Scratch
from admitflow.llm.decontam import decontaminate
from admitflow.llm.langid import identify_language, train_language_models
from admitflow.llm.ngram_join import ngram_jaccard_join
from admitflow.llm.packing import pack_sequences
from admitflow.llm.quality import score_quality, train_quality_model


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], added: list[str], keep: str) -> DataFrame:
    """Rows of ``docs`` that ``judge`` marks in ``keep``; columns with the names that it adds are put aside."""
    aside = {c: f"{c} of documents" for c in docs.columns if c in added}
    kept = judge(docs.withColumnsRenamed(aside)).where(keep).drop(*added)
    return kept.withColumnsRenamed({new: old for old, new in aside.items()}).select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = train_quality_model(docs)
    return _judged(docs, lambda d: score_quality(d, model), ["quality", "weak_label", "accepted"], "accepted")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the models learn from all documents with a language."""
    model = train_language_models(docs)
    return _judged(docs, lambda d: identify_language(d, model), ["lang_pred", "score", "cross_entropy", "rejected"], "not rejected")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row, in the order of the input, of each group of near duplicates.

    Rows are told apart by a key of their own, so null and repeated doc_ids are treated as any other: of equal rows
    one stays, and of rows with one doc_id each whose text is no near copy of an earlier one. Blank texts all stay.
    """
    key = "row"
    while key in docs.columns:
        key += "_"
    rows = Scratch(spark).save(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    classes = ngram_jaccard_join(rows.select(F.col(key).alias("doc_id"), "text"))
    first = classes.where("doc_id = class_id").select(F.col("doc_id").alias(key))
    # One way at every size: a merge join, though the keys of a small table could be broadcast.
    return rows.join(first.hint("merge"), key, "left_semi").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that hold the documents left."""
    return pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Trained models and edit distances can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written before the next stage reads it."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
