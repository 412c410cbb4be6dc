"""Queries of this package over the driver tables, and their SQL."""

from __future__ import annotations

from .op01_spaced_seeds import op1_spaced_seeds
from .op02_cuckoo_dedup import OP2_SQL, op2_cuckoo_dedup
from .op03_suffix_dedup import op3_suffix_dedup
from .op04_best_fit_pack import op4_best_fit_pack
from .op05_template_lines import OP5_SQL, op5_template_lines
from .op06_arrow_tokens import op6_arrow_tokens
from .op07_minimax_shards import op7_minimax_shards
from .op08_pii import op8_pii
from .op09_language_fusion import op9_language_fusion
from .op10_minhash_join import op10_minhash_join
from .op11_bit_planes import OP11_SQL, op11_bit_planes
from .op12_metric_tree import OP12_SQL, op12_metric_tree
from .op13_align_tokenizers import op13_align_tokenizers

QUERIES = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_cuckoo_dedup": op2_cuckoo_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_best_fit_pack": op4_best_fit_pack,
    "op5_template_lines": op5_template_lines,
    "op6_arrow_tokens": op6_arrow_tokens,
    "op7_minimax_shards": op7_minimax_shards,
    "op8_pii": op8_pii,
    "op9_language_fusion": op9_language_fusion,
    "op10_minhash_join": op10_minhash_join,
    "op11_bit_planes": op11_bit_planes,
    "op12_metric_tree": op12_metric_tree,
    "op13_align_tokenizers": op13_align_tokenizers,
}

# DuckDB SQL; the others are tested against brute force in tests/llm
ORACLE_SQL = {
    "op2_cuckoo_dedup": OP2_SQL,
    "op5_template_lines": OP5_SQL,
    "op11_bit_planes": OP11_SQL,
    "op12_metric_tree": OP12_SQL,
}
