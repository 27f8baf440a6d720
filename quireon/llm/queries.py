"""Queries and SQL of the training-data operators, for the driver's contract."""

from . import byte_bpe, decontaminate, exact_dedup, fill_middle, html_text, language_id, lattice_lm, line_dedup, near_dedup, quality, substring_dedup, token_counts, whitening

QUERIES = {
    "op1_byte_bpe": byte_bpe.op1_byte_bpe,
    "op2_lm_scores": lattice_lm.op2_lm_scores,
    "op3_language_id": language_id.op3_language_id,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_html_text": html_text.op10_html_text,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_quality": quality.op12_quality,
    "op13_whitening": whitening.op13_whitening,
}
ORACLE_SQL = {"op8_exact_dedup": exact_dedup.OP8_SQL, "op9_line_dedup": line_dedup.OP9_SQL, "op11_fill_middle": fill_middle.OP11_SQL}
