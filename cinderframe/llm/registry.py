"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, language_id, packing, pitman_yor, prefix_trie, quality, sentencepiece_sampling, sharding, simhash, suffix_dedup, topk_search, toxicity, turn_repair


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk_search": topk_search.op1_topk_search,
        "op2_sentencepiece": sentencepiece_sampling.op2_sentencepiece,
        "op3_quality": quality.op3_quality,
        "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
        "op5_sharding": sharding.op5_sharding,
        "op6_packing": packing.op6_packing,
        "op7_simhash": simhash.op7_simhash,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_language_id": language_id.op9_language_id,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_pitman_yor": pitman_yor.op12_pitman_yor,
        "op13_turn_repair": turn_repair.op13_turn_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": topk_search.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE}
