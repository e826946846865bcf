"""The corpus queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covelake.llm import chat_format, embed_dedup
from covelake.llm.bpe_codec import bpe_digests
from covelake.llm.decontaminate import contaminated
from covelake.llm.html_extract import main_texts
from covelake.llm.lm_score import lm_scores
from covelake.llm.quality_crf import quality_scores
from covelake.llm.simhash_dedup import simhash_groups
from covelake.llm.suffix_dedup import suffix_dedup
from covelake.llm.toxicity_cnn import toxicity_scores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op2_tool_calls(spark, sf_dir):
    return chat_format.link_calls(*chat_format.from_conversations(table(spark, sf_dir, "conversations")), chat_format.SCHEMAS)


def op3_pq_vectors(spark, sf_dir):
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_main_text(spark, sf_dir):
    return main_texts(table(spark, sf_dir, "pages"))


def op5_lattice_lm(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    got = simhash_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_crf(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe(spark, sf_dir):
    return bpe_digests(table(spark, sf_dir, "documents"))


def op9_toxicity_cnn(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_string_tiling(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (op1_suffix_dedup, op2_tool_calls, op3_pq_vectors, op4_main_text, op5_lattice_lm, op6_simhash, op7_quality_crf, op8_bpe, op9_toxicity_cnn, op10_string_tiling)
}
ORACLES = {"op2_tool_calls": chat_format.ORACLE, "op3_pq_vectors": embed_dedup.ORACLE}
