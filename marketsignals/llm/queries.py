"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from . import (chat_format, decontaminate, mixing, pair_bitmaps, prefix_trie, quality_model, quality_rules, secrets, simhash,
               spotsigs, substring_dedup, suffix_dedup, warc)

QUERIES = {
    "op1_simhash_dedup": simhash.op1,
    "op2_benchmark_decontamination": decontaminate.op2,
    "op3_substring_dedup": substring_dedup.op3,
    "op4_source_mixing": mixing.op4,
    "op5_secret_scan": secrets.op5,
    "op6_warc": warc.op6,
    "op7_quality_classifier": quality_model.op7,
    "op8_quality_rules": quality_rules.op8,
    "op9_suffix_dedup": suffix_dedup.op9,
    "op10_chat_format": chat_format.op10,
    "op11_prefix_trie": prefix_trie.op11,
    "op12_spotsigs": spotsigs.op12,
    "op13_pair_bitmaps": pair_bitmaps.op13,
}

ORACLES: dict[str, str] = {
    "op4_source_mixing": mixing.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op8_quality_rules": quality_rules.OP8_SQL,
    "op10_chat_format": chat_format.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
}
