"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cratework.llm import decontaminate, mixing, quality, simhash, token_ids
from cratework.llm.common import Scratch, prepare, table
from cratework.llm.queries import END_ID, QUALITY_LEAST, tokenizer_path
from cratework.session import fresh_folder

# Quality labels of all kinds may be learned from here; no row is held out.


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, under the bound of op6."""
    prepare(spark)
    space = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), "quality")
    return quality.keep_good(docs, space, QUALITY_LEAST)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: three-word shingles, at most two bits."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage is found."""
    prepare(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the weighted mix of its source takes it."""
    prepare(spark)
    return mixing.apply_mix(docs, weights=(1, 2, 3), most=3)


def as_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the token files, read back."""
    prepare(spark)
    folder = fresh_folder(spark, "pipeline-tokens")
    token_ids.write_ids(docs, folder, tokenizer_path(), END_ID)
    return token_ids.id_digests(token_ids.read_ids(spark, folder))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mix", mixed_sources),
    ("token_ids", as_token_ids),
]

# Classifier and balanced sample are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    prepare(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return scratch.stage(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
