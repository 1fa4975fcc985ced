"""Corpus pipeline: language, near duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns a DataFrame with the columns of ``documents``; the last returns packed pieces.

Defined results, stage by stage as in the operators' docstrings: documents of null or empty
text, or without a letter, go in the first stage; texts are read whole, however long;
repeated rows are near duplicates of each other, and of every group the row of the smallest
id stays (of equal ids the first, null ids last); extra columns pass through all stages but
the last unchanged, whatever they are called; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.llm import jaccard, langid, mixing, packing, pii
from rewardmill.llm.common import doc_bucket, materialise
from rewardmill.llm.queries import MIX_DOMAINS, MIX_WEIGHTS, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or far from every learned language, go."""
    train_on = F.coalesce(doc_bucket("doc_id", 4) != 2, F.lit(False))
    return langid.keep_identified(docs, train_on)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that five-word shingles link at Jaccard 0.75 stays."""
    return jaccard.keep_one(docs, n=5, percent=75)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data found in the texts gives way to its kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, dealt to domains, languages and sources by weight."""
    levels = {
        "domain": mixing.number_domain(F.col("source"), MIX_DOMAINS),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }
    return mixing.choose(docs, levels, MIX_WEIGHTS, budget_share=0.8, seed=17)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language, joins over shingles and the packing search are beyond SQL: tests compare the
#: pipeline with brute force on a small fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
