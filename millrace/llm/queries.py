"""One query per training-data operator over the test tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, hard_negatives, mixing, repair, topk
from millrace.llm.bpe import encode_digest
from millrace.llm.common import n_words, source, text_session, whole
from millrace.llm.packing import packed
from millrace.llm.quality_rules import quality_report
from millrace.llm.simhash import near_duplicates
from millrace.llm.suffix_dedup import suffix_report
from millrace.llm.suffix_tree import score_texts
from millrace.llm.token_counts import section_tokens
from millrace.llm.toxicity import held_out, toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(text_session(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@query("op1_mix_sources", mixing.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents").select("doc_id", "source", n_words(whole("text")).alias("size"))
    rows = mixing.copies(docs, size=F.col("size"))
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op2_suffix_tree_lm")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(source(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 10))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return section_tokens(source(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op5_chat_format", chat.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(source(spark, sf_dir, "conversations"))


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_digest(source(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(source(spark, sf_dir, "documents"))


@query("op7_exact_topk", topk.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = source(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return topk.exact_topk(vectors, F.col("id") % 50 == 0, k=5)


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(source(spark, sf_dir, "documents"), source(spark, sf_dir, "labels"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(source(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_report(source(spark, sf_dir, "documents"), source(spark, sf_dir, "labels"))
    return report.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("rule").cast("int").alias("rule")
    )


@query("op11_best_fit_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(source(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op12_hard_negatives", hard_negatives.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.shifted_labels(source(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


@query("op13_structure_repair", repair.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.structure_report(source(spark, sf_dir, "conversations"))
