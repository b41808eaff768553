"""Registered queries of the training-data operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from . import alignment, audit, chat, decontaminate, jaccard, language, lines, lm, mixing, pii, quality, substrings, warc

QUERIES = {
    "op1_string_tiling": (decontaminate.query, None),
    "op2_context_mixing": (lm.query, None),
    "op3_risk_thresholds": (quality.query, None),
    "op4_prefix_targets": (chat.query, chat.SQL),
    "op5_parity_sketch": (jaccard.query, None),
    "op6_deletion_lines": (lines.query, None),
    "op7_bootstrapped_pii": (pii.query, None),
    "op8_pivotal_mix": (mixing.query, None),
    "op9_language_bitmask": (language.query, None),
    "op10_zip_warc": (warc.query, warc.SQL),
    "op11_path_audit": (audit.query, audit.SQL),
    "op12_countmin_substrings": (substrings.query, substrings.SQL),
    "op13_perfect_hash_alignment": (alignment.query, None),
}
