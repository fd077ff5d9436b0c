"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from .decontamination import op7_decontamination
from .html_text import op8_html
from .lm_scoring import op9_lm_scoring
from .minhash import op10_minhash
from .mixing import op1_mixing
from .pii import op3_pii
from .sharding import op6_sharding
from .suffix_dedup import op2_suffix_dedup
from .topk import OP4_SQL, op4_topk
from .toxicity import op5_toxicity

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii": op3_pii,
    "op4_topk": op4_topk,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_decontamination": op7_decontamination,
    "op8_html": op8_html,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_minhash": op10_minhash,
}

#: The other methods can't be written as SQL over whole tables; tests hold them to brute force.
ORACLE_SQL: dict[str, str] = {"op4_topk": OP4_SQL}
