"""The queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from readloom.llm import (
    collocations,
    decontamination,
    jaccard,
    language_id,
    licences,
    packing,
    preferences,
    quality_compression,
    quality_rules,
    sharding,
    spelling,
    token_files,
    toxicity,
)

QUERIES = {
    "op1_quality_compression": quality_compression.op1_quality_compression,
    "op2_language_id": language_id.op2_language_id,
    "op3_jump_sharding": sharding.op3_jump_sharding,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_token_files": token_files.op6_token_files,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_preference_format": preferences.op8_preference_format,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
    "op11_collocations": collocations.op11_collocations,
    "op12_licence_scan": licences.op12_licence_scan,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLE_SQL = {
    "op3_jump_sharding": sharding.OP3_SQL,
    "op8_preference_format": preferences.OP8_SQL,
    "op10_ngram_jaccard": jaccard.OP10_SQL,
    "op11_collocations": collocations.OP11_SQL,
}
