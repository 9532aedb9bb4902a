"""Corpus cleaning from documents to packed training sequences: five stages, each on what the one before kept.

Language ID drops documents without a language. Line dedup takes repeated lines out of the texts. SimHash
near-dedup keeps one document of each group of near copies. Decontamination drops documents that hold a passage of the
benchmark. Packing gives the place of every piece of what is left. Every stage but the last returns the columns of
``documents``; line dedup sets n_chars to the length of the new text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm import decontaminate, language, line_dedup, near_copies, packing
from skylag.session import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, as the held-out rule of language ID allows it to learn."""
    learn = docs.where(~F.coalesce(language.held_out(), F.lit(False)))
    found = language.identify(docs, language.training_samples(learn))
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that at least five hold, but for the largest doc_id holding each."""
    kept = line_dedup.dedup_lines(docs, min_docs=5, min_chars=40)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word similarity of 0.8 or more: the one with the smallest doc_id.

    Candidates come from SimHash fingerprints alone and are verified on their shingles.
    """
    return near_copies.keep_one(docs, shingle=5, similarity=0.8, by=near_copies.SIMHASH)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece in sequences of 4096 tokens."""
    return packing.pack_documents(docs, capacity=4096)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near_copies),
    ("decontamination", decontaminate_documents),
    ("packing", pack_documents),
]

#: Fingerprints, fuzzy overlaps and packings have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
