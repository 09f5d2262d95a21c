"""A training-corpus pipeline: each stage works on all rows that the one before kept.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet below the shared checkpoint folder and reads again as the next stage's docs. All but the last
return the columns of ``documents``. Filters drop rows only for the reason of their stage: a document that line
dedup leaves without lines goes on with an empty text.

All stages take an empty table (and then return none) and any further columns, which all but the last hand on.
Rows with a null doc_id stay unless a stage judges their text; null texts are as stated for each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import byte_bpe, decontaminate, line_dedup, rule_quality, simhash
from clickloom.llm.common import shared_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, trained on the labelled ones, scores at least 0.5; null texts count as empty, rows that repeat an id are judged one by one."""
    return rule_quality.keep_good(docs, rule_quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that stand, or nearly stand, earlier; null texts stay null, repeated rows of one id and text have one result."""
    return line_dedup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates; null and empty texts are one group, rows of a null id stay."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark; null texts have no words and stay, null items have no windows."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of each document; null texts count as empty, repeated rows are repeated."""
    trip = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.digests(trip, "ids")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", benchmark), ("tokens", tokens)]

#: Trees, fingerprints and merges cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.drop("ids")
