"""The queries of this package and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import exact, mixing, packing, pii, quality, sharding, simhash, substring, tokenids, transducer


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_best_fit_packing": packing.op2_best_fit_packing,
        "op3_substring_dedup": substring.op3_substring_dedup,
        "op4_token_files": tokenids.op4_token_files,
        "op5_jump_shards": sharding.op5_jump_shards,
        "op6_pii_pseudonyms": pii.op6_pii_pseudonyms,
        "op7_mix_sources": mixing.op7_mix_sources,
        "op8_exact_dedup": exact.op8_exact_dedup,
        "op9_token_counts": transducer.op9_token_counts,
        "op10_quality_rules": quality.op10_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jump_shards": sharding.OP5_SQL,
        "op7_mix_sources": mixing.OP7_SQL,
        "op8_exact_dedup": exact.OP8_SQL,
    }
