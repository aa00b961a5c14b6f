"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from vecspark.llm import (bin_packing, cover_codes, decontaminate, html_text, jaccard_join, lang_id, licenses, minhash, secrets,
                          suffix_dedup, token_file, vp_tree, whitening)

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_html_text": html_text.op2_html_text,
    "op3_licenses": licenses.op3_licenses,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_token_file": token_file.op5_token_file,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_language_id": lang_id.op7_language_id,
    "op8_vp_tree": vp_tree.op8_vp_tree,
    "op9_minhash": minhash.op9_minhash,
    "op10_packing": bin_packing.op10_packing,
    "op11_cover_codes": cover_codes.op11_cover_codes,
    "op12_whitening": whitening.op12_whitening,
    "op13_jaccard_join": jaccard_join.op13_jaccard_join,
}

ORACLES = {
    "op1_secrets": secrets.OP1_SQL,
    "op3_licenses": licenses.OP3_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op6_suffix_dedup": suffix_dedup.OP6_SQL,
    "op8_vp_tree": vp_tree.OP8_SQL,
    "op9_minhash": minhash.OP9_SQL,
    "op11_cover_codes": cover_codes.OP11_SQL,
    "op13_jaccard_join": jaccard_join.OP13_SQL,
}
