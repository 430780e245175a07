"""The corpus pipeline: each stage calls one operator on all rows its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import minhash, packing, quality, toxicity
from punctual.session import ensure_checkpoints


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the importance sample go; all columns stay as they are.

    A null or empty text counts as one without n-grams, a row with a null id shares one noise value
    with its like, repeated rows share their fate. No documents give none.
    """

    return quality.keep_important(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the classifier learns from the labelled ones of ``docs``.

    Texts are judged by themselves, so repeated rows share their fate; a null or empty text has the
    score of the bias. All columns stay as they are.
    """

    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.remove_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays; rows without an id stay as they are."""

    found = minhash.near_duplicates(docs.select("doc_id", "text"))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole texts in sequences of at most 2048 ids, one row per piece; a null text is an empty one."""

    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality", quality_filter),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: Learned decisions and tokenisation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""

    folder = f"{ensure_checkpoints(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
