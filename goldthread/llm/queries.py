"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from goldthread.llm.conversations import repair_digest
from goldthread.llm.decontaminate import contamination
from goldthread.llm.main_text import extract_main_text
from goldthread.llm.near_duplicates import near_duplicates
from goldthread.llm.neighbours import nearest_neighbours
from goldthread.llm.oracles import ORACLES as ORACLES
from goldthread.llm.packing import pack
from goldthread.llm.phrases import collocations
from goldthread.llm.quality import classify
from goldthread.llm.repeated_spans import repeated_digest
from goldthread.llm.secret_scan import secret_digest
from goldthread.llm.simhash import simhash_classes
from goldthread.llm.token_counts import count_tokens
from goldthread.llm.token_files import token_file_digest

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), WORD_BPE, end_id=2)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), WORD_BPE, end_id=1)


def op4_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), WORD_BPE)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_harmonic_packing, op2_near_duplicates, op3_token_files, op4_repeated_spans, op5_token_counts, op6_decontamination,
    op7_nearest_neighbours, op8_secret_scan, op9_main_text, op10_quality, op11_simhash, op12_conversation_repair, op13_collocations)}
