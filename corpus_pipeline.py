"""From raw documents to token ids in five stages, each written as Parquet and read again by the next.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of documents, whatever else there is beside them. A null text counts as an empty one everywhere,
repeated rows are rows of their own, and an empty table goes through as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tempora.llm import bpe, crf, mixing, pii, simhash
from tempora.llm.common import documents, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go; with no labelled document to learn from, none does. Null keys are
    scored like others, but never learnt from."""
    model = crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return crf.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one of the least key, null last, then of the least text
    hash. Blank and null texts are one class."""
    return simhash.keep_one(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind, in each row by itself; a null text stays null."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them, up to three times; null sources are a source of their own, and
    documents without words come with their source's share."""
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document; a null text has none."""
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("privacy", privacy), ("mixture", mixture), ("tokens", tokens)]

#: SQL has no expression for the classifier, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
