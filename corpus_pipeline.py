"""A corpus pipeline over ``documents``: five stages, each written and read again.

Language identification, one document of each near-duplicate group, benchmark
decontamination, mixing sources to target weights, and packed token ids.  Each
stage takes what its predecessor kept; all but the last return rows with the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propmart.llm import decontaminate, language, lsh_forest, mixing, packing
from propmart.llm.common import ship_package, written
from propmart.llm.queries import byte_bpe

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without letters or without a main language go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group linked by 5-word Jaccard of 0.8 or more."""
    return lsh_forest.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near a 5:2:1 mix."""
    return mixing.mix(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of the mix: doc_id, start, n_tokens and ids_crc32 per copy."""
    return packing.pack_and_read(docs, byte_bpe())


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the rows are those of the last one."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-stage{number + 1}")
    return docs


# models and tokenizers have no SQL form
ORACLE_SQL = None
