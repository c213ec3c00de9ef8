"""The queries of the ten corpus operators and the pipeline, with their SQL."""

from __future__ import annotations

from . import bloom_lm, decontaminate, mixing, pii, simhash, stages, suffix_dedup, token_rollup, topk, toxicity, url_filter


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_token_rollup": token_rollup.op2_token_rollup,
        "op3_suffix_array_dedup": suffix_dedup.op3_suffix_array_dedup,
        "op4_bloom_lm": bloom_lm.op4_bloom_lm,
        "op5_decontamination": decontaminate.op5_decontamination,
        "op6_url_filter": url_filter.op6_url_filter,
        "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
        "op8_exact_topk": topk.op8_exact_topk,
        "op9_pii": pii.op9_pii,
        "op10_source_mixing": mixing.op10_source_mixing,
        "pipeline": stages.run,
    }


def oracle_sql() -> dict:
    return {
        "op2_token_rollup": token_rollup.ORACLE_SQL,
        "op5_decontamination": decontaminate.ORACLE_SQL,
        "op6_url_filter": url_filter.ORACLE_SQL,
        "op8_exact_topk": topk.ORACLE_SQL,
    }
