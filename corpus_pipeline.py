"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the stage
before kept. The stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.exact_dedup import drop_exact_duplicates
from tidemark.llm.language import keep_identified
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import packed
from tidemark.llm.simhash import drop_near_duplicates
from tidemark.sources.scratch import materialize, use_local_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of 3-word shingles link at 3 bits or fewer."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]

#: Language, fingerprint links and the local search can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written and read again by the next."""
    use_local_scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
