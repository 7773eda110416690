"""The operators' registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from .decontamination import op7_benchmark_decontamination
from .html_extraction import OP11_SQL, op11_html_extraction
from .line_dedup import OP10_SQL, op10_line_dedup
from .merkle import OP12_SQL, op12_merkle_manifest
from .packing import op1_sum_of_squares_packing
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .private_terms import op8_private_terms
from .quality_classifier import op5_quality_classifier
from .quality_rules import op2_distribution_divergence
from .simhash import op9_simhash_near_dedup
from .substring_dedup import OP6_SQL, op6_substring_dedup
from .suffix_dedup import OP3_SQL, op3_suffix_array_dedup
from .toxicity import op4_toxicity

QUERIES = {
    "op1_sum_of_squares_packing": op1_sum_of_squares_packing,
    "op2_distribution_divergence": op2_distribution_divergence,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_private_terms": op8_private_terms,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL = {
    "op3_suffix_array_dedup": OP3_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_html_extraction": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
