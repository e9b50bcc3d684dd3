"""Queries of the llm operators and, where SQL can express them over whole tables, their SQL."""

from __future__ import annotations

from . import confusables, incremental, language, leakage, lines, mojibake, packing, residue

QUERIES = {
    "p1_found": mojibake.p1_found,
    "p1_restored": mojibake.p1_restored,
    "p2_found": incremental.p2_found,
    "p3_found": lines.p3_found,
    "p5_found": residue.p5_found,
    "p6_found": residue.p6_found,
    "p7_found": language.p7_found,
    "p7_documents": language.p7_documents,
    "p7_segments": language.p7_segments,
    "p8_pack": packing.p8_pack,
    "p8_token_counts": packing.p8_token_counts,
    "p9_found": leakage.p9_found,
    "p10_found": confusables.p10_found,
    "p10_groups": confusables.p10_groups,
    "p10_plain": confusables.p10_plain,
}

SQL = {
    "p3_found": lines.P3_SQL,
    "p8_token_counts": packing.P8_TOKENS_SQL,
}
