"""Queries of the llm operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import exact_dedup, maxent, mixing, packing, pii, quality_rules, rule_ensemble, simhash, substrings, toxicity

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_rule_ensemble": rule_ensemble.op3_rule_ensemble,
    "op4_maxent": maxent.op4_maxent,
    "op5_pii_surrogates": pii.op5_pii_surrogates,
    "op6_simhash": simhash.op6_simhash,
    "op7_packing": packing.op7_packing,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_substrings": substrings.op9_substrings,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
}
