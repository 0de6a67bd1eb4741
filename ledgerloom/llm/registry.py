"""The corpus queries and their SQL, for the entry module to add."""

from __future__ import annotations

from ledgerloom.llm import chat, divergence, embeddings, licenses, lm, minhash, mixing, packing, quality, secret_scan, substrings, toxicity, whitening


def queries() -> dict:
    return {
        "op1_quality_rules": quality.op1_quality_rules,
        "op2_license_scans": licenses.op2_license_scans,
        "op3_embedding_near_dedup": embeddings.op3_embedding_near_dedup,
        "op4_packing": packing.op4_packing,
        "op5_source_mix": mixing.op5_source_mix,
        "op6_lm_score": lm.op6_lm_score,
        "op7_secret_scans": secret_scan.op7_secret_scans,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_minhash_near_dedup": minhash.op9_minhash_near_dedup,
        "op10_substring_dedup": substrings.op10_substring_dedup,
        "op11_embedding_whitening": whitening.op11_embedding_whitening,
        "op12_source_divergence": divergence.op12_source_divergence,
        "op13_chat_formatting": chat.op13_chat_formatting,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scans": licenses.op2_sql(), "op5_source_mix": mixing.op5_sql(), "op12_source_divergence": divergence.op12_sql(), "op13_chat_formatting": chat.op13_sql()}
