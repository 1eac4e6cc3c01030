"""The queries of this subpackage, and their SQL where SQL can state them."""

from __future__ import annotations

from .alignment import op11_alignment
from .bpe import op5_bpe
from .decontamination import op1_decontamination
from .katz import op12_katz
from .licences import OP7_SQL, op7_licences
from .line_dedup import OP6_SQL, op6_line_dedup
from .merkle import OP13_SQL, op13_merkle
from .near_dedup import op4_near_dedup
from .neighbours import op10_neighbours
from .secrets import op9_secrets
from .suffix_dedup import op2_suffix_dedup
from .token_counts import op8_token_counts
from .toxicity import op3_toxicity

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_near_dedup": op4_near_dedup,
    "op5_bpe": op5_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_licences": op7_licences,
    "op8_token_counts": op8_token_counts,
    "op9_secrets": op9_secrets,
    "op10_neighbours": op10_neighbours,
    "op11_alignment": op11_alignment,
    "op12_katz": op12_katz,
    "op13_merkle": op13_merkle,
}
ORACLES: dict[str, str] = {
    "op6_line_dedup": OP6_SQL,
    "op7_licences": OP7_SQL,
    "op13_merkle": OP13_SQL,
}
