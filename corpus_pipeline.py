"""A corpus pipeline of five stages over ``documents``: language ID, exact dedup, near dedup, mixing, packing.

Each stage works on all rows that its predecessor kept, as written and read again; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm.base import keep
from lotwise.llm.exact_dedup import drop_copies
from lotwise.llm.language_id import known_language
from lotwise.llm.mixing import mix
from lotwise.llm.ngram_join import one_of_each_group
from lotwise.llm.packing import pack

#: Near copies: word shingles of this many words, similar by this percentage or more.
SHINGLE_WORDS, SIMILARITY = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is undecided, go."""
    return known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays."""
    return one_of_each_group(docs, SHINGLE_WORDS, SIMILARITY)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's repetition rate says."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as pieces of token sequences; a repeated document is packed each time."""
    return pack(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: SQL states neither the language model nor the token ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "stage-" + "-".join(name.lower().split()))
    return docs
