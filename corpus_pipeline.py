"""Documents to training tokens: filter, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept and wrote; all but the last
return the columns of ``documents``.  What each does with nulls, empty texts, ties, repeated rows, empty tables and
further columns is said in the docstring of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.llm import exact_dedup, mixing, simhash, toxicity
from pluvia.llm.common import read, written
from pluvia.llm.queries import bpe_round_trip, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels outside the held-out fold."""
    return toxicity.reject_toxic(docs, toxicity_model(spark, sf_dir, docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their SimHash the one with the smallest id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to three times, or not at all."""
    draws = mixing.with_quality(mixing.with_draws(docs), read(spark, sf_dir, "labels"))
    return mixing.take_copies(docs, mixing.mix(draws))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit numbers) of every row, and a digest of the bytes they decode to."""
    return bpe_round_trip(docs).select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: The trained classifier cannot be said in SQL; test_pipeline in tests/llm/test_llm_tokens.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
