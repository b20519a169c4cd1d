"""The corpus queries by name, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import chat, html_text, language, mixing, notices, quality, simhash, tiling, tokens, topk, toxicity, turn_repair, whitening

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_reply_trees": chat.op2_reply_trees,
    "op3_toxicity_neighbours": toxicity.op3_toxicity_neighbours,
    "op4_quality_ranking": quality.op4_quality_ranking,
    "op5_impact_topk": topk.op5_impact_topk,
    "op6_language_ppm": language.op6_language_ppm,
    "op7_poisson_mixing": mixing.op7_poisson_mixing,
    "op8_html_text": html_text.op8_html_text,
    "op9_benchmark_tiling": tiling.op9_benchmark_tiling,
    "op10_license_notices": notices.op10_license_notices,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_turn_repair": turn_repair.op12_turn_repair,
    "op13_token_counts": tokens.op13_token_counts,
}

ORACLE_SQL = {
    "op2_reply_trees": chat.ORACLE_SQL,
    "op5_impact_topk": topk.ORACLE_SQL,
    "op7_poisson_mixing": mixing.ORACLE_SQL,
}
