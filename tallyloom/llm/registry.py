"""The queries of this folder by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tallyloom.llm import exact_copies, prefix_trie, ranked_search, warc
from tallyloom.llm.byte_merges import op13_byte_level_bpe
from tallyloom.llm.exact_copies import op5_golomb_exact_dedup
from tallyloom.llm.mixing import op9_soft_membership_mixing
from tallyloom.llm.order_minhash import op1_order_minhash_near_dedup
from tallyloom.llm.packing import op3_bound_certified_packing
from tallyloom.llm.prefix_counts import op6_prefix_token_counts
from tallyloom.llm.prefix_trie import op12_conversation_prefix_trie
from tallyloom.llm.ranked_search import op11_hybrid_ranked_search
from tallyloom.llm.repeated_passages import op10_suffix_sorted_passages
from tallyloom.llm.scaled_sketch import op7_scaled_sketch_fingerprints
from tallyloom.llm.simple8b import op8_simple8b_token_ids
from tallyloom.llm.toxicity import op4_factorization_toxicity
from tallyloom.llm.warc import op2_warc_capture_index

QUERIES = {
    "op1_order_minhash_near_dedup": op1_order_minhash_near_dedup,
    "op2_warc_capture_index": op2_warc_capture_index,
    "op3_bound_certified_packing": op3_bound_certified_packing,
    "op4_factorization_toxicity": op4_factorization_toxicity,
    "op5_golomb_exact_dedup": op5_golomb_exact_dedup,
    "op6_prefix_token_counts": op6_prefix_token_counts,
    "op7_scaled_sketch_fingerprints": op7_scaled_sketch_fingerprints,
    "op8_simple8b_token_ids": op8_simple8b_token_ids,
    "op9_soft_membership_mixing": op9_soft_membership_mixing,
    "op10_suffix_sorted_passages": op10_suffix_sorted_passages,
    "op11_hybrid_ranked_search": op11_hybrid_ranked_search,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_byte_level_bpe": op13_byte_level_bpe,
}
SQL = {
    "op2_warc_capture_index": warc.SQL,
    "op5_golomb_exact_dedup": exact_copies.SQL,
    "op11_hybrid_ranked_search": ranked_search.SQL,
    "op12_conversation_prefix_trie": prefix_trie.SQL,
}
