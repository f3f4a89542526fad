"""The corpus operators' queries, each over whole tables, and SQL where that can express them."""

from __future__ import annotations

from tidemark.llm import chat, contamination, divergence, language, lines, neardup, packing, quality, scoring, secrets, spelling, substrings, warc

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_language_id": language.op4_language_id,
    "op5_benchmark_decontamination": contamination.op5_benchmark_decontamination,
    "op6_lm_scoring": scoring.op6_lm_scoring,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_content_addressed_warc": warc.op8_content_addressed_warc,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_ngram_jaccard_join": neardup.op10_ngram_jaccard_join,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_chat_formatting": chat.op13_chat_formatting,
}

ORACLE_SQL = {
    "op1_line_dedup": lines.OP1_SQL,
    "op2_substring_dedup": substrings.OP2_SQL,
    "op3_quality_rules": quality.OP3_SQL,
    "op5_benchmark_decontamination": contamination.OP5_SQL,
    "op8_content_addressed_warc": warc.OP8_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
    "op12_spelling_variants": spelling.OP12_SQL,
    "op13_chat_formatting": chat.OP13_SQL,
}
