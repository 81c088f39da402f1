"""The registered queries of this subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

import corpus_pipeline

from . import oracles
from .bbit_minhash import op7_bbit_minhash
from .block_names import op10_exact_dedup
from .fst_pieces import op4_fst_pieces
from .hnsw import op6_hnsw
from .hpy_lm import op2_hpy_lm
from .orc_tokens import op5_orc_tokens
from .perspectives import op3_perspectives
from .secret_scan import op1_secret_scan
from .segment_langid import op9_segment_langid
from .set_skip_join import op12_set_skip_join
from .swap_pack import op8_best_fit_pack
from .token_align import op11_token_align
from .word_runs import op13_word_runs

QUERIES = [op1_secret_scan, op2_hpy_lm, op3_perspectives, op4_fst_pieces, op5_orc_tokens, op6_hnsw, op7_bbit_minhash,
           op8_best_fit_pack, op9_segment_langid, op10_exact_dedup,
           op11_token_align, op12_set_skip_join, op13_word_runs]


def queries() -> dict:
    return {q.__name__: q for q in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
