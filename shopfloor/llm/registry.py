"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from shopfloor.llm import (
    chat,
    classifier,
    embedding,
    fingerprints,
    langid,
    minhash,
    mixing,
    negatives,
    packing,
    quality_rules,
    resampling,
    sharding,
    statements,
    tokens,
)


def queries() -> dict:
    return {
        "op1_minhash_dedup": minhash.op1_minhash_dedup,
        "op2_embedding_dedup": embedding.op2_embedding_dedup,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_mix_sources": mixing.op4_mix_sources,
        "op5_token_counts": tokens.op5_token_counts,
        "op6_quality_classifier": classifier.op6_quality_classifier,
        "op7_pack_sequences": packing.op7_pack_sequences,
        "op8_language_id": langid.op8_language_id,
        "op9_chat_format": chat.op9_chat_format,
        "op10_shard_documents": sharding.op10_shard_documents,
        "op11_hard_negatives": negatives.op11_hard_negatives,
        "op12_importance_resampling": resampling.op12_importance_resampling,
        "op13_document_fingerprints": fingerprints.op13_document_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return dict(statements.SQL)
