"""Queries of this subpackage: name -> callable, and the DuckDB SQL where SQL can express them."""

from __future__ import annotations

from castline.llm import (byte_bpe, exact_dedup, html_text, langid, line_dedup, merkle, mixing, ngram_join, quality, secrets,
                          suffix_dedup, token_files, whitening)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_html_text": html_text.op2_html_text,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_byte_bpe": byte_bpe.op4_byte_bpe,
    "op5_token_files": token_files.op5_token_files,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_language_id": langid.op7_language_id,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_suffix_dedup": suffix_dedup.op12_suffix_dedup,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op3_ngram_join": ngram_join.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
