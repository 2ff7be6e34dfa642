"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelf.llm import bpe, embed_dedup, mixing, pii, quality, sharding, simhash, tokenbin, toxicity, urlfilter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name -> function of (spark, sf_dir)."""
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_simhash": simhash.op2_simhash,
        "op3_urlfilter": urlfilter.op3_urlfilter,
        "op4_quality": quality.op4_quality,
        "op5_embeddings": embed_dedup.op5_embeddings,
        "op6_mixing": mixing.op6_mixing,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_pii": pii.op8_pii,
        "op9_bpe": bpe.op9_bpe,
        "op10_tokens": tokenbin.op10_tokens,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL over the same tables."""
    return {"op1_sharding": sharding.ORACLE, "op3_urlfilter": urlfilter.ORACLE, "op4_quality": quality.ORACLE, "op5_embeddings": embed_dedup.ORACLE}
