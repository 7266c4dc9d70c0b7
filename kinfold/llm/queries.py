"""Queries of the pipeline operators and the SQL of those that SQL can express."""

from . import (
    chat_format,
    decontamination,
    exact_dedup,
    html_extraction,
    language_id,
    merkle_manifest,
    mixing,
    periodic_runs,
    quality_lm,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
)

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_simhash": simhash.query,
    "op3_decontamination": decontamination.query,
    "op4_quality_lm": quality_lm.query,
    "op5_chat_format": chat_format.query,
    "op6_mixing": mixing.query,
    "op7_suffix_dedup": suffix_dedup.query,
    "op8_html_extraction": html_extraction.query,
    "op9_token_counts": token_counts.query,
    "op10_quality_rules": quality_rules.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_exact_dedup": exact_dedup.query,
    "op13_merkle_manifest": merkle_manifest.query,
}

SQL = {"op3_decontamination": decontamination.SQL, "op6_mixing": mixing.SQL, "op12_exact_dedup": exact_dedup.SQL, "op13_merkle_manifest": merkle_manifest.SQL}
