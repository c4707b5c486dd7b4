"""The queries of this folder and their SQL."""

from __future__ import annotations

from ionsift.llm import (
    byte_bpe, conversations, line_crf, line_dedup, minhash, packing, quality, ranked, suffix_dedup, syncmers, toxicity,
    url_filter, warc,
)

QUERIES = {
    "op1_document_fingerprints": syncmers.op1_document_fingerprints,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_packing": packing.op4_packing,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_warc": warc.op6_warc,
    "op7_url_filters": url_filter.op7_url_filters,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_minhash_dedup": minhash.op9_minhash_dedup,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_quality_crf": line_crf.op12_quality_crf,
    "op13_ranked_search": ranked.op13_ranked_search,
}

SQL = {
    "op6_warc": warc.OP6_SQL,
    "op7_url_filters": url_filter.op7_sql(),
    "op11_conversation_repair": conversations.OP11_SQL,
    "op13_ranked_search": ranked.OP13_SQL,
}
