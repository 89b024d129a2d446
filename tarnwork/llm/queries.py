"""The operators' queries, each over its whole table, and SQL for those that SQL can say."""

from __future__ import annotations

from tarnwork.llm import (
    attribution, chat, conversation_repair, language, lempel_ziv, line_templates, mixing, neural_lm, packing, passages, simhash, token_alignment,
    vector_forest,
)

QUERIES = {
    f.__name__: f
    for f in (
        line_templates.op1_line_template_dedup,
        mixing.op2_golden_ratio_mix,
        lempel_ziv.op3_lempel_ziv_fingerprint,
        simhash.op4_simhash_ball_dedup,
        vector_forest.op5_projection_forest,
        packing.op6_cost_balanced_packing,
        attribution.op7_offset_attribution,
        language.op8_language_mixture,
        chat.op9_offset_aligned_chat,
        neural_lm.op10_recurrent_lm,
        token_alignment.op11_identity_map_alignment,
        conversation_repair.op12_conversation_repair,
        passages.op13_repeated_phrase_automata,
    )
}
#: An earlier name of the same query.
QUERIES["op1_every_line_dedup"] = line_templates.op1_line_template_dedup
ORACLES: dict[str, str] = {
    "op1_line_template_dedup": line_templates.OP1_SQL,
    "op1_every_line_dedup": line_templates.OP1_SQL,
    "op13_repeated_phrase_automata": passages.OP13_SQL,
}
