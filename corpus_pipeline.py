"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeforge.llm import mixing, near_dup, packing, pii, quality
from tapeforge.llm.common import read, stored
from tapeforge.llm.queries import TEST_KEY

#: The file of the tokenizer that counts and packs.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak supervision finds good; the others go."""
    return quality.good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the least doc_id."""
    return near_dup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; n_chars follows the text. The key is the session's; TEST_KEY is for synthetic tables."""
    return pii.replace(docs, pii.configured_key(spark, TEST_KEY)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target weights of source, language and topic."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]
#: Expectation-maximisation, MinHash, keyed surrogates, raking and packing are beyond SQL; tests/llm holds a small run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
QUERY_SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
