"""Queries of this subpackage, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chroma, embedding_dedup, language_id, licences, line_dedup, mixing, near_dup, sentencepiece_codec, substring_dedup, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_near_dedup": embedding_dedup.op1_embedding_near_dedup,
        "op2_substring_dedup": substring_dedup.op2_substring_dedup,
        "op3_mixing": mixing.op3_mixing,
        "op4_minhash_near_dedup": near_dup.op4_minhash_near_dedup,
        "op5_license_scan": licences.op5_license_scan,
        "op6_chroma_fingerprints": chroma.op6_chroma_fingerprints,
        "op7_sentencepiece": sentencepiece_codec.op7_sentencepiece,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_language_id": language_id.op10_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": embedding_dedup.OP1_SQL,
        "op2_substring_dedup": substring_dedup.OP2_SQL,
        "op3_mixing": mixing.OP3_SQL,
        "op4_minhash_near_dedup": near_dup.OP4_SQL,
        "op8_line_dedup": line_dedup.OP8_SQL,
    }
