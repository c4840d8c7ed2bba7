"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, chat, decontamination, extraction, jaccard, licenses, lines, neighbours, overwrite, quality, repeats, resampling, sharding, sql

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_bpe": bpe.op2_bpe,
    "op3_licenses": licenses.op3_licenses,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_repeats": repeats.op6_repeats,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_quality": quality.op8_quality,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_chat": chat.op10_chat,
    "op11_html": extraction.op11_html,
    "op12_resampling": resampling.op12_resampling,
    "op13_overwrite": overwrite.op13_overwrite,
}


def oracles() -> dict[str, str]:
    return {"op1_sharding": sharding.oracle(), "op4_jaccard": sql.JACCARD, "op7_decontamination": sql.DECONTAMINATION, "op10_chat": sql.CHAT, "op12_resampling": sql.RESAMPLING}
