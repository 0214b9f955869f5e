"""The registered queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    collision_hashing,
    exact_dedup,
    licences,
    merkle,
    mixing,
    simhash,
    spelling,
    suffix_dedup,
    token_scan,
    toxicity,
    wavelet,
    winnowing,
)
from .common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, end_id = public_tokenizers.path("byte_bpe_50k.json"), 50256  # <|endoftext|>
    folder, placed = token_scan.write_token_files(read(spark, sf_dir, "documents"), vocabulary, end_id)
    found = token_scan.scan_token_files(spark, folder, end_id, width=2)
    return found.join(placed, ["file", "number"]).select("doc_id", "file", "number", "start", "n_tokens", "ended")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = mixing.with_quality(mixing.with_draws(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"))
    return mixing.mix(draws).select("doc_id", "source", "size", "source_size", "target", "taken")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, read(spark, sf_dir, "labels"), F.coalesce(toxicity.fold() != 1, F.lit(False)))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scores.select(
        "doc_id",
        (toxicity.fold() == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents")).drop("row_key")


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = winnowing.compare_with_next(read(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.digest(F.col("marks")).alias("fingerprint"),
        winnowing.digest(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op9_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    # The library as it comes: the string of a special token becomes its id.
    path = wavelet.write_shards(read(spark, sf_dir, "documents"), vocabulary, end_id=2, special_as_text=False)
    return wavelet.read_documents(spark, path)


def bpe_round_trip(docs: DataFrame) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_hashing.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_tampering(read(spark, sf_dir, "documents"), merkle.every_fifth()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_licence_scan": op2_licence_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_winnowing": op8_winnowing,
    "op9_wavelet_files": op9_wavelet_files,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_collision_neighbours": op11_collision_neighbours,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = {
    "op2_licence_scan": licences.SQL,
    "op4_mix_sources": f"SELECT doc_id, source, size, source_size, target, taken FROM ({mixing.SQL})",
    "op7_exact_dedup": exact_dedup.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
