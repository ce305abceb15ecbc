"""Queries of the corpus operators, and their SQL where SQL can express them."""

from corpuskiln.llm import chat, exact_dedup, jaccard, lexical, linededup, media, mixing, pieces, substring, tokencounts, toxicity, trie, urlfilter, views

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_jaccard_join": jaccard.op2_jaccard_join,
    "op3_media_columns": media.op3_media_columns,
    "op4_substring_dedup": substring.op4_substring_dedup,
    "op5_token_counts": tokencounts.op5_token_counts,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_line_dedup": linededup.op7_line_dedup,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_url_filter": urlfilter.op9_url_filter,
    "op10_mixing": mixing.op10_mixing,
    "op11_chat_format": chat.op11_chat_format,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_ranked_search": lexical.op13_ranked_search,
    "repeated_lines": substring.repeated_lines,
    "jaccard_links": views.jaccard_links,
    "media_payloads": views.media_payloads,
    "equal_lines": views.equal_lines,
    "url_rules": views.url_rules,
}

ORACLE = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_chat_format": chat.OP11_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
    "op13_ranked_search": lexical.OP13_SQL,
    "repeated_lines": substring.LINES_SQL,
    "jaccard_links": views.LINKS_SQL,
    "media_payloads": views.PAYLOADS_SQL,
    "equal_lines": views.EQUAL_LINES_SQL,
    "url_rules": views.RULES_SQL,
}
