"""The queries of this subpackage, and the SQL of those that SQL can express."""

from siftmill.llm import contamination, embedding, exact_dedup, minhash, mixing, packing, quality, repair, sharding, substring, tokens, trie, urls

QUERIES = {
    "op1_minhash": minhash.op1_minhash,
    "op2_url_filters": urls.op2_url_filters,
    "op3_substring_dedup": substring.op3_substring_dedup,
    "op4_quality": quality.op4_quality,
    "op5_token_counts": tokens.op5_token_counts,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_sharding": sharding.op8_sharding,
    "op9_embedding_dedup": embedding.op9_embedding_dedup,
    "op10_packing": packing.op10_packing,
    "op11_decontamination": contamination.op11_decontamination,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_structure_repair": repair.op13_structure_repair,
}
ORACLES = {
    "op1_minhash": minhash.OP1_SQL,
    "op3_substring_dedup": substring.OP3_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op9_embedding_dedup": embedding.OP9_SQL,
    "op11_decontamination": contamination.OP11_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
    "op13_structure_repair": repair.OP13_SQL,
}
