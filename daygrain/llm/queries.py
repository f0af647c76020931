"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from daygrain.llm import (
    bpe,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    language_id,
    mixing,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    vector_codes,
    warc,
)

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_embedding_dedup": embedding_dedup.op2,
    "op3_substring_dedup": substring_dedup.op3,
    "op4_exact_dedup": exact_dedup.op4,
    "op5_bpe": bpe.op5,
    "op6_warc": warc.op6,
    "op7_simhash": simhash.op7,
    "op8_language_id": language_id.op8,
    "op9_sharding": sharding.op9,
    "op10_token_counts": token_counts.op10,
    "op11_secret_scan": secret_scan.op11,
    "op12_conversation_repair": conversation_repair.op12,
    "op13_vector_codes": vector_codes.op13,
}

ORACLE = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op2_embedding_dedup": embedding_dedup.OP2_SQL,
    "op3_substring_dedup": substring_dedup.OP3_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op7_simhash": simhash.OP7_SQL,
    "op9_sharding": sharding.OP9_SQL,
    "op12_conversation_repair": conversation_repair.OP12_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
