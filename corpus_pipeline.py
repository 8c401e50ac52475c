"""The corpus pipeline: from raw documents to token ids in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import bpe, decontaminate, jaccard, pii, quality
from eventlake.llm.common import checkpointed, fold, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return quality.keep_good(docs, model, quality.GOOD)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group linked by five-word shingles at similarity 0.8."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of ten words of a benchmark item occurs."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms replaced by placeholders."""
    return pii.sanitise(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text they decode to."""
    coded = bpe.encode_decode(docs)
    return coded.select("doc_id", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("benchmark decontamination", benchmark_stage),
    ("personal data", personal_data_stage),
    ("byte-level BPE", tokens_stage),
]
# The first stage is a trained model, which SQL does not express; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
