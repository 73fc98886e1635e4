"""The queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from trackloom.llm.op1 import op1_pack_sequences
from trackloom.llm.op2 import op2_fingerprints
from trackloom.llm.op3 import ORACLE as OP3_ORACLE
from trackloom.llm.op3 import op3_arc_to_warc
from trackloom.llm.op4 import op4_simhash_groups
from trackloom.llm.op5 import op5_token_rollup
from trackloom.llm.op6 import op6_personal_data
from trackloom.llm.op7 import ORACLE as OP7_ORACLE
from trackloom.llm.op7 import op7_exact_topk
from trackloom.llm.op8 import op8_toxicity
from trackloom.llm.op9 import op9_mix_sources
from trackloom.llm.op10 import op10_hilbert_shards
from trackloom.llm.op11 import op11_quality_votes
from trackloom.llm.op12 import ORACLE as OP12_ORACLE
from trackloom.llm.op12 import op12_merkle_manifest
from trackloom.llm.op13 import ORACLE as OP13_ORACLE
from trackloom.llm.op13 import op13_lexical_search


def queries() -> dict:
    found = [op1_pack_sequences, op2_fingerprints, op3_arc_to_warc, op4_simhash_groups, op5_token_rollup, op6_personal_data, op7_exact_topk, op8_toxicity, op9_mix_sources, op10_hilbert_shards, op11_quality_votes, op12_merkle_manifest, op13_lexical_search]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_arc_to_warc": OP3_ORACLE, "op7_exact_topk": OP7_ORACLE, "op12_merkle_manifest": OP12_ORACLE, "op13_lexical_search": OP13_ORACLE}
