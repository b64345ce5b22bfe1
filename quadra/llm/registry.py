"""The queries of the training-data operators and their DuckDB SQL, where SQL can express them."""

from quadra.llm import anomaly, chat, decontaminate, htmltree, langid, linededup, mixing, ngramjoin, prefixtrie, quality, secrets, sharding, whitening

QUERIES = {
    "op1_bounded_ring": sharding.op1_bounded_ring,
    "op2_isolation": anomaly.op2_isolation,
    "op3_secrets": secrets.op3_secrets,
    "op4_chat": chat.op4_chat,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_line_dedup": linededup.op6_line_dedup,
    "op7_mixed": mixing.op7_mixed,
    "op8_language": langid.op8_language,
    "op9_ngram_join": ngramjoin.op9_ngram_join,
    "op10_bradley_terry": quality.op10_bradley_terry,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_whitened": whitening.op12_whitened,
    "op13_html": htmltree.op13_html,
}
ORACLE_SQL = {
    "op3_secrets": secrets.OP3_SQL,
    "op4_chat": chat.OP4_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op6_line_dedup": linededup.OP6_SQL,
    "op7_mixed": mixing.OP7_SQL,
    "op9_ngram_join": ngramjoin.OP9_SQL,
    "op11_prefix_trie": prefixtrie.OP11_SQL,
}
