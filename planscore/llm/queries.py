"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline
from planscore.llm import (best_fit_packing, entropy_mix, exact_dedup, hard_negatives,
                           iblt_fingerprint, language_id, line_dedup, minhash_hamming,
                           secret_ledger, sentencepiece_bpe, toxicity, warc_revisits, whitening)

LLM_QUERIES = {
    "op1_language_byte_cnn": language_id.op1,
    "op2_warc_revisits": warc_revisits.op2,
    "op3_iblt_fingerprint": iblt_fingerprint.op3,
    "op4_toxicity_automaton": toxicity.op4,
    "op5_secret_blob_ledger": secret_ledger.op5,
    "op6_entropy_mix": entropy_mix.op6,
    "op7_sentencepiece_rounds": sentencepiece_bpe.op7,
    "op8_line_window_dedup": line_dedup.op8,
    "op9_minhash_hamming": minhash_hamming.op9,
    "op10_exact_tree_merge": exact_dedup.op10,
    "op11_four_russians_negatives": hard_negatives.op11,
    "op12_best_fit_packing": best_fit_packing.op12,
    "op13_polarised_whitening": whitening.op13,
    "pipeline": corpus_pipeline.run,
}

# The other queries are not expressible in SQL; tests/llm holds them against brute force.
LLM_ORACLE = {
    "op2_warc_revisits": warc_revisits.OP2_SQL,
    "op5_secret_blob_ledger": secret_ledger.OP5_SQL,
    "op8_line_window_dedup": line_dedup.OP8_SQL,
    "op10_exact_tree_merge": exact_dedup.OP10_SQL,
    "op11_four_russians_negatives": hard_negatives.OP11_SQL,
}
