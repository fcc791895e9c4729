"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from vitrail.llm import (
    ann,
    byte_bpe,
    chat,
    hard_negatives,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    quality,
    spelling,
    token_counts,
    toxicity,
    warc,
)


def registry() -> dict:
    return {
        "op1_quality_divergence": quality.op1_quality,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op5_token_counts": token_counts.op5_token_counts,
        "op8_byte_bpe": byte_bpe.op8_byte_bpe,
        "op7_best_fit_packing": packing.op7_best_fit_packing,
        "op6_toxicity": toxicity.op6_toxicity,
        "op3_chat_format": chat.op3_chat_format,
        "op4_warc": warc.op4_warc,
        "op10_ann_forest": ann.op10_ann_forest,
        "op9_jaccard_join": jaccard_join.op9_jaccard_join,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_mix_sources": mixing.op13_mix_sources,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.OP2_SQL,
        "op3_chat_format": chat.OP3_SQL,
        "op4_warc": warc.OP4_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op12_spelling_variants": spelling.OP12_SQL,
        "op13_mix_sources": mixing.OP13_SQL,
    }
