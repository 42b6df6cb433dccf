"""Corpus pipeline: language ID, toxicity, near-duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents.  ``run`` writes each stage's result as Parquet in the shared checkpoint folder and reads it back as the
next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pixelmill.llm import lang_id, packing, simhash, substring_dedup, toxicity
from pixelmill.llm.common import store, table

#: Packing and the models are not expressible in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; learned and calibrated from all labelled rows of the corpus itself."""
    model = lang_id.fit_all(docs)
    return lang_id.keep_known(docs, model, lang_id.calibrate(docs, model))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go; learned from all labelled documents."""
    return toxicity.keep_clean(docs, toxicity.fit_all(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8)."""
    return simhash.keep_one(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows go; a text that lost words is its kept words joined by spaces.

    Documents that keep no word go, texts without words stay.  Every row carries its own columns through, so rows
    without an id or with another's id stay what they are, one row each.
    """
    return substring_dedup.without_repeats(docs, size_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens in the corpus's own mixture of sources."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, lambda: packing.WordEncoder(path)).drop("ids")


STAGES = [
    ("language", language),
    ("toxicity", clean),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
