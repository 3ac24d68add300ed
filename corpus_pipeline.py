"""From raw documents to training tokens, one stage after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import encode_documents
from millrace.llm.common import source, text_session, written
from millrace.llm.mixing import mixed
from millrace.llm.quality_rules import quality_filter
from millrace.llm.simhash import drop_near_duplicates
from millrace.llm.suffix_dedup import drop_repeats

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base thresholds and the learned rules keep."""
    return quality_filter(docs, source(text_session(spark), sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: three-word shingles, two differing bits."""
    text_session(spark)
    return drop_near_duplicates(docs, shingle=3, distance=2)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes of 100-byte strings that start earlier in the corpus."""
    text_session(spark)
    return drop_repeats(docs, length=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, sources weighing 3, 1, 2, repeating."""
    text_session(spark)
    return mixed(docs, weights=(3, 1, 2), share=1.5, limit=2.0)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digest of the text decoded from the ids, for every document of the mix.

    The ids stream back through the UTF-8 machine at once; ids that do not give their text stop the job.
    """
    text_session(spark)
    return encode_documents(docs, RANKS, public_tokenizers.PATTERN, decode=True).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", byte_bpe),
]

#: No SQL for all of run(): the tests compare it with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what the one before has written."""
    docs = source(text_session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
