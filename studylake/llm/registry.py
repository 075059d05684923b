"""Registered queries of the text operators and their DuckDB equivalents."""

from __future__ import annotations

from studylake.llm import ann_multiprobe, bpe_chunks, chat_parts, conversation_repair, decontaminate, html_style_tree, ngram_jaccard, quality_fm, secret_ledger, token_attribution, toxicity_ordinal, url_redirects, vector_codes

QUERIES = {
    "op1_offset_attribution": token_attribution.op1_offset_attribution,
    "op2_ordinal_severity": toxicity_ordinal.op2_ordinal_severity,
    "op3_redirect_equivalence": url_redirects.op3_redirect_equivalence,
    "op4_multiprobe": ann_multiprobe.op4_multiprobe,
    "op5_factorisation_machine": quality_fm.op5_factorisation_machine,
    "op6_seed_align": decontaminate.op6_seed_align,
    "op7_style_tree": html_style_tree.op7_style_tree,
    "op8_bitmap_tiles": ngram_jaccard.op8_bitmap_tiles,
    "op9_chunk_reuse": bpe_chunks.op9_chunk_reuse,
    "op10_blob_ledger": secret_ledger.op10_blob_ledger,
    "op11_typed_parts": chat_parts.op11_typed_parts,
    "op12_four_russians": conversation_repair.op12_four_russians,
    "op13_ball_kmeans": vector_codes.op13_ball_kmeans,
}

ORACLE = {
    "op3_redirect_equivalence": url_redirects.SQL,
    "op8_bitmap_tiles": ngram_jaccard.SQL,
    "op10_blob_ledger": secret_ledger.SQL,
    "op11_typed_parts": chat_parts.SQL,
    "op12_four_russians": conversation_repair.SQL,
    "op13_ball_kmeans": vector_codes.SQL,
}
