"""The registered queries of this package and the check text of those that SQL can state."""

from __future__ import annotations

import corpus_pipeline
from eventloom.llm import (
    bitsliced_topk, exact_dedup, gumbel_pieces, k2_treap, kd_shards, license_scan, maxent_lm, packing, simhash_trie, toxicity_cnn,
    url_cascade, warc_zstd, whitening,
)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_kd_shards": kd_shards.op2_kd_shards,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_bitsliced_topk": bitsliced_topk.op4_bitsliced_topk,
    "op5_warc_zstd": warc_zstd.op5_warc_zstd,
    "op6_url_cascade": url_cascade.op6_url_cascade,
    "op7_mixture_packing": packing.op7_mixture_packing,
    "op8_toxicity_cnn": toxicity_cnn.op8_toxicity_cnn,
    "op9_simhash_trie": simhash_trie.op9_simhash_trie,
    "op10_gumbel_pieces": gumbel_pieces.op10_gumbel_pieces,
    "op11_k2_treap": k2_treap.op11_k2_treap,
    "op12_bidiagonal_whitening": whitening.op12_bidiagonal_whitening,
    "op13_maxent_lm": maxent_lm.op13_maxent_lm,
    "pipeline": corpus_pipeline.run,
}
CHECKS = {
    "op3_exact_dedup": exact_dedup.SQL,
    "op4_bitsliced_topk": bitsliced_topk.SQL,
    "op5_warc_zstd": warc_zstd.SQL,
    "op6_url_cascade": url_cascade.SQL,
    "op11_k2_treap": k2_treap.SQL,
}
