"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldthread.llm.common import shared_path
from goldthread.llm.decontaminate import decontaminated
from goldthread.llm.near_duplicates import without_near_duplicates
from goldthread.llm.packing import pack
from goldthread.llm.quality import accepted
from goldthread.llm.queries import WORD_BPE
from goldthread.llm.secret_scan import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark passage."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return pack(docs, WORD_BPE)


STAGES = [
    ("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
    ("secret scan", secrets), ("packing", packing)]

#: Sampling, a fitted classifier and a tokenizer have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
