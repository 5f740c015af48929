"""The registered queries of this subpackage: name to (query, SQL twin or None)."""

from __future__ import annotations

from arealis.llm import bpe, centroids, exact_dedup, jaccard_join, language_id, main_text, mixing, passages, private_data, sharding, token_index, turns, vector_join

QUERIES = {
    "op1_language_id": (language_id.op1_language_id, None),
    "op2_exact_dedup": (exact_dedup.op2_exact_dedup, exact_dedup.ORACLE),
    "op5_jaccard_join": (jaccard_join.op5_jaccard_join, jaccard_join.ORACLE),
    "op6_mix_sources": (mixing.op6_mix_sources, mixing.ORACLE),
    "op3_vector_join": (vector_join.op3_vector_join, vector_join.ORACLE),
    "op4_token_index": (token_index.op4_token_index, None),
    "op7_repeated_passages": (passages.op7_repeated_passages, None),
    "op8_main_text": (main_text.op8_main_text, main_text.ORACLE),
    "op9_bpe_round_trip": (bpe.op9_bpe_round_trip, None),
    "op10_private_data": (private_data.op10_private_data, None),
    "op11_centroids": (centroids.op11_centroids, centroids.ORACLE),
    "op12_turns": (turns.op12_turns, turns.ORACLE),
    "op13_shards": (sharding.op13_shards, sharding.ORACLE),
}
