"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm.hardnegatives import op11_hard_negatives
from tidemark.llm.lattice import op4_near_vectors
from tidemark.llm.linededup import op5_line_dedup
from tidemark.llm.lmscore import op10_lm_scoring
from tidemark.llm.mixing import op2_mixing
from tidemark.llm.ngramjoin import op3_ngram_join
from tidemark.llm.oracle import ORACLE
from tidemark.llm.packing import op8_best_fit_packing
from tidemark.llm.pieces import op13_fill_in_middle
from tidemark.llm.quality import op1_quality_rules
from tidemark.llm.rarefeatures import op12_fingerprints
from tidemark.llm.suffixdedup import op6_suffix_dedup
from tidemark.llm.tokencount import op7_token_counts
from tidemark.llm.tokenstore import op9_token_store

QUERIES = {
    query.__name__: query
    for query in [
        op1_quality_rules,
        op2_mixing,
        op3_ngram_join,
        op4_near_vectors,
        op5_line_dedup,
        op6_suffix_dedup,
        op7_token_counts,
        op8_best_fit_packing,
        op9_token_store,
        op10_lm_scoring,
        op11_hard_negatives,
        op12_fingerprints,
        op13_fill_in_middle,
    ]
}

__all__ = ["ORACLE", "QUERIES"]
