"""The corpus queries registered with the driver, and the SQL that must give the same rows where there is such."""

from __future__ import annotations

from . import (
    ann_tree, byte_bpe, hard_negatives, language, lexical, line_dedup, mixing, quality_crf, rotation_codes, simhash, suffix_dedup, token_files, url_cascade,
)

QUERIES = {
    "op1_url_cascade": url_cascade.op1_url_cascade,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_quality_crf": quality_crf.op3_quality_crf,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op6_token_files": token_files.op6_token_files,
    "op7_simhash": simhash.op7_simhash,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_ann_tree": ann_tree.op9_ann_tree,
    "op10_language": language.op10_language,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_lexical": lexical.op12_lexical,
    "op13_rotation_codes": rotation_codes.op13_rotation_codes,
}

ORACLES = {
    "op1_url_cascade": url_cascade.OP1_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_lexical": lexical.OP12_SQL,
    "op13_rotation_codes": rotation_codes.OP13_SQL,
}
