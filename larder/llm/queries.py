"""Queries of this package by name, and their SQL twins."""

from __future__ import annotations

from larder.llm import exact_dedup, filter_audit, hamming_search, language_id, line_dedup, near_dedup, pieces, quality_vote, repeat_removal, source_mix, token_count, vector_codes, warc

QUERIES = {
    "op1_token_counts": token_count.query,
    "op2_warc": warc.query,
    "op3_hamming_search": hamming_search.query,
    "op4_language_id": language_id.query,
    "op5_near_dedup": near_dedup.query,
    "op6_source_mix": source_mix.query,
    "op7_exact_dedup": exact_dedup.query,
    "op8_pieces": pieces.query,
    "op9_quality_vote": quality_vote.query,
    "op10_line_dedup": line_dedup.query,
    "op11_vector_codes": vector_codes.query,
    "op12_filter_audit": filter_audit.query,
    "op13_repeat_removal": repeat_removal.query,
}
ORACLE = {
    "op2_warc": warc.SQL,
    "op3_hamming_search": hamming_search.SQL,
    "op6_source_mix": source_mix.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_repeat_removal": repeat_removal.SQL,
}
