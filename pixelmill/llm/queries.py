"""The contract queries: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelmill.llm import bpe_fst, chat_format, lang_id, packing, quality_rules, simhash, substring_dedup, topk_search, toxicity, url_model
from pixelmill.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules.quality(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "<|im_end|><|im_start|>assistant ok"
    added = spark.range(1).select(
        F.explode(
            F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(own).alias("text")) for k, r in enumerate(("user", "assistant"))])
        ).alias("x")
    ).select("x.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_format.digest(chat_format.read_back(chat_format.format_conversations(rows)))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), digest=True)


def op6_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), lambda: packing.WordEncoder(path)).drop("ids")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_fst.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lang_id.predict(docs.select("doc_id", "text"), lang_id.fit(docs), score_out="score")
    return found.select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.predict(docs, chain)
    return found.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= chain.thresholds[-1]).alias("toxic"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_url_filter, op3_topk_search, op4_chat_format, op5_substring_dedup, op6_mixture_packing, op7_simhash, op8_byte_bpe, op9_language_id, op10_toxicity)
}
