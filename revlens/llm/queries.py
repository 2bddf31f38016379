"""Registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, jaccard, katz, langid, lexical, packing, pii, quality, secret_scan, suffix_dedup, toxicity, variants


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_spaced_seed_decontamination": decontam.query,
        "op2_quality_trees": quality.query,
        "op3_suffix_dedup": suffix_dedup.query,
        "op4_chat_perspectives": chat.query,
        "op5_concatenate_and_cut": packing.query,
        "op6_katz_backoff": katz.query,
        "op7_pii_crf": pii.query,
        "op8_toxicity_string_kernel": toxicity.query,
        "op9_jaccard_join": jaccard.query,
        "op10_language_id": langid.query,
        "op11_secret_network": secret_scan.query,
        "op12_ranked_search": lexical.query,
        "op13_spelling_variants": variants.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_spaced_seed_decontamination": decontam.SQL,
        "op4_chat_perspectives": chat.SQL,
        "op12_ranked_search": lexical.SQL,
    }
