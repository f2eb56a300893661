"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from chainlens.llm import chat, decontam, exact_dedup, html_extract, line_dedup, period_runs, pii, quality_classifier, quality_rules, sentencepiece_lattice, simhash_dedup, token_align, toxicity


def queries() -> dict:
    return {
        "op1_chat_formatting": chat.op1_chat_formatting,
        "op2_benchmark_decontamination": decontam.op2_benchmark_decontamination,
        "op3_html_extraction": html_extract.op3_html_extraction,
        "op4_sentencepiece": sentencepiece_lattice.op4_sentencepiece,
        "op5_pii": pii.op5_pii,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_simhash_near_dedup": simhash_dedup.op7_simhash_near_dedup,
        "op8_quality_classifier": quality_classifier.op8_quality_classifier,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_token_alignment": token_align.op11_token_alignment,
        "op12_exact_dedup": exact_dedup.op12_exact_dedup,
        "op13_period_runs": period_runs.op13_period_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": chat.ORACLE_SQL, "op6_line_dedup": line_dedup.ORACLE_SQL, "op10_quality_rules": quality_rules.ORACLE_SQL,
            "op12_exact_dedup": exact_dedup.ORACLE_SQL}
