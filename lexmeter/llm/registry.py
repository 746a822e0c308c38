"""The queries of this package by name, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmeter.llm import (
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    token_alignment,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: tuple[Query, ...] = (
    simhash.op1_simhash_near_dedup,
    mixing.op2_curriculum_mix,
    line_dedup.op3_site_line_dedup,
    language_id.op4_language_id,
    quality_classifier.op5_fourier_quality,
    sharding.op6_stratified_shards,
    quality_rules.op7_weak_supervision,
    decontamination.op8_benchmark_decontamination,
    license_scan.op9_license_scan,
    secret_scan.op10_secret_ledger,
    jaccard_join.op11_jaccard_join,
    vector_codes.op12_ball_vector_codes,
    token_alignment.op13_token_alignment,
)

SQL: dict[str, str] = {
    "op3_site_line_dedup": line_dedup.OP3_SQL,
    "op10_secret_ledger": secret_scan.OP10_SQL,
    "op2_curriculum_mix": mixing.OP2_SQL,
    "op8_benchmark_decontamination": decontamination.OP8_SQL,
    "op11_jaccard_join": jaccard_join.OP11_SQL,
    "op12_ball_vector_codes": vector_codes.OP12_SQL,
}


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}
