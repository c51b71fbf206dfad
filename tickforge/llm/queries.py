"""The queries of this subpackage and, where SQL can express one, its reference SQL."""

from __future__ import annotations

import corpus_pipeline
from tickforge.llm import (ann, bpe, exact_dedup, hard_negatives, html_text, jaccard_join, langid, mixing, pii, secret_scan, sharding,
                           toxicity, whitening)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_sharding": sharding.op2_sharding,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_ann": ann.op5_ann,
    "op6_bpe": bpe.op6_bpe,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_secrets": secret_scan.op8_secrets,
    "op9_language_id": langid.op9_language_id,
    "op10_html_text": html_text.op10_html_text,
    "op11_whitening": whitening.op11_whitening,
    "op12_pii": pii.op12_pii,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_mixing": mixing.OP1_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op12_pii": pii.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
