"""The operators' queries over the driver's tables, and their SQL where it can express them."""

from __future__ import annotations

from . import chat_format, decontaminate, exact_dedup, html_extract, jaccard_join, langid, merkle, packing, prefix_trie, quality, token_counts, toxicity, url_filter

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_token_counts": token_counts.query,
    "op3_quality": quality.query,
    "op4_url_filter": url_filter.query,
    "op5_chat_format": chat_format.query,
    "op6_jaccard_join": jaccard_join.query,
    "op7_decontaminate": decontaminate.query,
    "op8_toxicity": toxicity.query,
    "op9_language": langid.query,
    "op10_pack": packing.query,
    "op11_html_extract": html_extract.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_merkle": merkle.query,
}
ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE, "op5_chat_format": chat_format.ORACLE, "op6_jaccard_join": jaccard_join.ORACLE, "op7_decontaminate": decontaminate.ORACLE, "op11_html_extract": html_extract.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE, "op13_merkle": merkle.ORACLE}
