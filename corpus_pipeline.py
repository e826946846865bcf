"""A corpus pipeline of five of the operators: each stage reads what the one before it kept.

The last stage returns the digests of the encoded documents; all others return the columns of documents.

Edge cases, in every stage: null and empty texts are documents without words; they are alike, so of those with an id the
first stays. Rows without a doc_id are never near copies and stay unless another stage's decision drops them; of a repeated
doc_id all rows stay or go as near copies together, and every other stage judges each row by itself. Equal texts keep the
smallest doc_id. An empty table yields no rows. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covelake.llm.bpe_codec import bpe_digests
from covelake.llm.common import materialise
from covelake.llm.decontaminate import decontaminate
from covelake.llm.quality_crf import quality_filter
from covelake.llm.simhash_dedup import near_dedup
from covelake.llm.suffix_dedup import drop_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality field rejects go."""
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id: SimHash links and an exact way for the rest, verified at a similarity of 0.8."""
    return near_dedup(docs, 0.8)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that stand earlier in the corpus go; so do documents left blank."""
    return drop_repeats(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_digests(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("leaks", leaks), ("encode", encode)]
#: The stages are models and hashes that SQL can't express; a test compares run() with a brute-force version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
