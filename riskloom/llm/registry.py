"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from . import (
    block_anchors,
    bpe,
    chat_windows,
    impact_topk,
    jaccard_groups,
    language_gru,
    mixing,
    periodic_runs,
    prefix_trie,
    quality_rules,
    token_counts,
    toxicity,
    warc_normalise,
)


def queries() -> dict:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_warc": warc_normalise.op3_warc,
        "op4_bpe": bpe.op4_bpe,
        "op5_jaccard": jaccard_groups.op5_jaccard,
        "op6_block_anchors": block_anchors.op6_block_anchors,
        "op7_language": language_gru.op7_language,
        "op8_topk": impact_topk.op8_topk,
        "op9_chat_windows": chat_windows.op9_chat_windows,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_periodic_runs": periodic_runs.op12_periodic_runs,
        "op13_token_counts": token_counts.op13_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express (not those with a classifier or a tokenizer)."""
    return {
        "op3_warc": warc_normalise.oracle_sql(),
        "op5_jaccard": jaccard_groups.oracle_sql(),
        "op6_block_anchors": block_anchors.oracle_sql(),
        "op8_topk": impact_topk.oracle_sql(),
        "op9_chat_windows": chat_windows.oracle_sql(),
        "op10_quality_rules": quality_rules.oracle_sql(),
        "op11_prefix_trie": prefix_trie.oracle_sql(),
    }
