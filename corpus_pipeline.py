"""The corpus pipeline: documents in, packed token sequences out, in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketrank.llm import language, packing, pii, quality, simhash
from docketrank.llm.common import prepare, read_table, stored
from docketrank.llm.queries import held_out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the fences of their language and source."""
    prepare(spark)
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language, which column ``lang`` then names."""
    prepare(spark)
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    return language.keep_known(docs, model)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the operator's own shingles and distance."""
    prepare(spark)
    return simhash.keep_one(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    prepare(spark)
    return pii.mask_personal_data(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1,024 tokens."""
    prepare(spark)
    return packing.pack(docs, packing.public_vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("mask_pii", mask_pii),
    ("best_fit_packing", best_fit_packing),
]

# The stages can't be written as SQL (hash functions, models, packing): tests/llm/test_pipeline.py
# compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over table ``documents``; each stage's rows are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
