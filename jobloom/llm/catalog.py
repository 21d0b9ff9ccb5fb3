"""The operators' queries, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobloom.llm import (
    consistent_shards,
    decontaminate,
    decontaminate_sql,
    fill_in_middle,
    language_id,
    license_scan,
    minhash,
    quality_divergence,
    sentencepiece_codec,
    simhash_dedup,
    source_divergence,
    token_files,
    toxicity,
    url_model,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        simhash_dedup.op1_simhash_dedup,
        license_scan.op2_license_scan,
        token_files.op3_token_files,
        consistent_shards.op4_consistent_shards,
        quality_divergence.op5_quality_divergence,
        url_model.op6_url_model,
        sentencepiece_codec.op7_sentencepiece,
        decontaminate.op8_decontaminate,
        language_id.op9_language_id,
        toxicity.op10_toxicity,
        fill_in_middle.op11_fill_in_middle,
        source_divergence.op12_source_divergence,
        minhash.op13_minhash_fingerprints,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op8_decontaminate": decontaminate_sql.SQL,
        "op11_fill_in_middle": fill_in_middle.SQL,
        "op12_source_divergence": source_divergence.SQL,
    }
