"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from partledger.llm import alignment, bpe, chat, hilbert, jaccard, language, mixing, periods, quality, substrings, suffixes, toxicity, url_filter

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_byte_level_bpe": bpe.op2_byte_level_bpe,
    "op3_mixing_sources": mixing.op3_mixing_sources,
    "op4_url_filters": url_filter.op4_url_filters,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_language_id": language.op6_language_id,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_suffix_array_dedup": suffixes.op9_suffix_array_dedup,
    "op10_hilbert_neighbours": hilbert.op10_hilbert_neighbours,
    "op11_tokenizer_alignment": alignment.op11_tokenizer_alignment,
    "op12_substring_dedup": substrings.op12_substring_dedup,
    "op13_periodic_runs": periods.op13_periodic_runs,
}
ORACLES = {
    "op8_chat_formatting": chat.ORACLE_SQL,
    "op4_url_filters": url_filter.ORACLE_SQL,
}
