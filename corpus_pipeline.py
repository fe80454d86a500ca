"""Corpus pipeline over ``documents``.

Toxic documents go, then those of low quality; one document of each group of
near-duplicates stays; repeated passages are cut out of what is left; the
rest is packed into training sequences.  Every stage is one operator of
``parley.llm`` applied to all rows that the stage before kept, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import packing, quality, simhash, substring, toxicity
from parley.llm.words import crc_mod, read, stage

#: SQL cannot express the classifiers, the tokenizer or the packing.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not call toxic; null and empty texts stay."""
    grammar = toxicity.learn(docs, read(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    return toxicity.reject(docs, grammar)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking keeps; texts without words score as such, ids are not looked at."""
    features = quality.measured(docs, keep_rows=True)
    ranker = quality.learn_measured(features, read(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return quality.good_rows(features, ranker)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id, then smallest text digest, of each group of near-duplicates.

    Texts without words are one group; a null id comes after all others.
    """
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; where a passage repeats an earlier one, the words that stay, by one space.

    Null ids come last, rows of one id in text order; null texts stay null.
    """
    cleaned = substring.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    size = F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars"))
    return cleaned.withColumns({"text": text, "n_chars": size.cast(docs.schema["n_chars"].dataType)}
                               ).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of every document that is left; a text without words is its end id."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [("toxicity", toxicity_stage), ("quality classifier", quality_stage),
          ("SimHash near-dedup", near_duplicate_stage), ("substring dedup", substring_stage),
          ("best-fit packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
