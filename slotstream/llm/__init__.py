"""Operators that prepare text for training language models, and their registered queries.

Nothing else in the library imports this subpackage.
"""

from __future__ import annotations

from slotstream.checks.base import Query
from slotstream.llm import (
    chat,
    decontaminate,
    jaccard,
    language,
    minhash,
    negatives,
    packing,
    pii,
    quality,
    sharding,
    suffix,
    tokens,
    variants,
)

QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_sharding": sharding.op2_sharding,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_chat_format": chat.op4_chat_format,
    "op5_suffix_dedup": suffix.op5_suffix_dedup,
    "op6_token_counts": tokens.op6_token_counts,
    "op7_pii_surrogates": pii.op7_pii_surrogates,
    "op8_language_id": language.op8_language_id,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_packing": packing.op10_packing,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_jaccard_join": jaccard.op13_jaccard_join,
}

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": minhash.OP1_SQL,
    "op4_chat_format": chat.OP4_SQL,
    "op5_suffix_dedup": suffix.OP5_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_spelling_variants": variants.OP12_SQL,
    "op13_jaccard_join": jaccard.OP13_SQL,
}
