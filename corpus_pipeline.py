"""Corpus preparation in five stages, each a training-data operator over all rows.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
frame.  Every stage's result is written as Parquet and read again as the next one's input.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import bpe, decontamination, neardup, substrings, toxicity
from changelake.llm.common import materialize, read_table
from changelake.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays."""
    return neardup.drop_near_duplicates(docs, neardup.NearDupParams(words=5))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 240 bytes or more, or of more than 50 words, that repeat are cut out of the texts; n_chars follows."""
    return substrings.drop_repeats(docs, substrings.RepeatParams(length=240, seed=96, words=51)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontamination.find_leaks(docs, read_table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hits") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the hashes of the ids and of the decoded text."""
    return bpe.encode_documents(docs, tokenizer_file()).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", encode),
]

# no SQL for nearest neighbours, components, byte spans and merges; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
