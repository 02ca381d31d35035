"""The queries of this subpackage, and their SQL where SQL can express them. A missing dependency of any operator shows on import."""

from __future__ import annotations

from . import convtrie, decontam, fingerprints, html, langid, licenses, neardup, packing, passages, quality, resampling, sharding, toxicity

#: Query name and the module that has it.
MODULES = {
    "op1_balanced_shards": sharding,
    "op2_repeated_passages": passages,
    "op3_main_text": html,
    "op4_fingerprints": fingerprints,
    "op5_toxicity": toxicity,
    "op6_quality": quality,
    "op7_language": langid,
    "op8_near_duplicates": neardup,
    "op9_packing": packing,
    "op10_decontamination": decontam,
    "op11_licenses": licenses,
    "op12_resampling": resampling,
    "op13_conversation_trie": convtrie,
}


def queries() -> dict:
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in MODULES.items() if hasattr(module, "SQL")}
