"""A training-data pipeline over documents: each stage is written as Parquet and reread as the next one's input.

Every stage works on all rows and whole texts of its input; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import bpe, decontaminate, jaccard_join, suffix_dedup, toxicity
from riskmart.llm.common import prepared
from riskmart.session import written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the lexicon predicts to be toxic."""
    prepared(spark)
    lexicon = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, lexicon)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates and whatever hangs together by them, the document with the smallest id."""
    return jaccard_join.deduplicated(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; bytes under 50-byte strings of a smaller document are cut, and n_chars follows."""
    return suffix_dedup.cleaned(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents one word in twenty or more of which is a benchmark item's."""
    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what the earlier stages kept."""
    import public_tokenizers

    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", not_toxic), ("ngram_jaccard", one_of_each_group), ("suffix_array", without_repeats),
          ("decontamination", without_benchmark), ("byte_bpe", encoded)]

#: Stages that learn, search or encode have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
