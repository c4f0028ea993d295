"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again.

Quality classifier, SimHash near-duplicates, secrets, source mix, token ids. A stage works on all rows
its predecessor kept. NULLs, empty texts, repeated rows and empty tables behave as each operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from blockpulse.llm import nb_svm, secret_scan, simhash, source_mix, stream_bpe
from blockpulse.llm.scratch import Scratch

#: SQL cannot fit the classifier, so the run has no equivalent statement.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.3 go. Labels are those of the `labels` table."""
    model = nb_svm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return nb_svm.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return simhash.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; `n_chars` follows the text."""
    return secret_scan.redact(docs, size_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their target sizes."""
    return source_mix.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and digests of the ids and of the decoded tokens."""
    found = stream_bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        kept = scratch.write(stage(spark, docs, sf_dir), name, merged=False)
        if name != STAGES[0][0]:
            scratch.drop(docs)
        docs = kept
    return docs
