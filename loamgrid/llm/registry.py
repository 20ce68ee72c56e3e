"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from loamgrid.llm import conversations, embeddings, exact_dedup, language, licenses, mixing, packing, periodic, pii, quality, secrets, simhash, substring_dedup


def queries() -> dict:
    return {
        "op1_mix_sources": mixing.op1_mix_sources,
        "op2_substring_dedup": substring_dedup.op2_substring_dedup,
        "op3_secret_scan": secrets.op3_secret_scan,
        "op4_exact_dedup": exact_dedup.op4_exact_dedup,
        "op5_license_scan": licenses.op5_license_scan,
        "op6_language_id": language.op6_language_id,
        "op7_packing": packing.op7_packing,
        "op8_quality_rules": quality.op8_quality_rules,
        "op9_personal_data": pii.op9_personal_data,
        "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
        "op11_conversation_repair": conversations.op11_conversation_repair,
        "op12_periodic_runs": periodic.op12_periodic_runs,
        "op13_embedding_near_dedup": embeddings.op13_embedding_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": mixing.OP1_SQL,
        "op4_exact_dedup": exact_dedup.OP4_SQL,
        "op8_quality_rules": quality.OP8_SQL,
        "op11_conversation_repair": conversations.OP11_SQL,
    }
