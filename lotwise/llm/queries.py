"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe_lexicon, chat_format, divergence, exact_dedup, html_extract, language_id, merkle, ngram_join, order_minhash, packing, sharding, simhash, training_order

QUERIES = {
    f.__name__: f
    for f in (
        html_extract.op1_host_suffix_html,
        language_id.op2_naive_bayes_lang,
        training_order.op3_feistel_order,
        packing.op4_bm25_packing,
        chat_format.op5_event_sourced_chat,
        exact_dedup.op6_bloom_exact_dedup,
        order_minhash.op7_order_minhash,
        simhash.op8_pigeonring_simhash,
        sharding.op9_prefix_sum_shards,
        bpe_lexicon.op10_lexicon_bpe,
        divergence.op11_radix_divergence,
        merkle.op12_merkle_manifest,
        ngram_join.op13_vertical_jaccard_join,
    )
}

SQL = {**chat_format.SQL, **exact_dedup.SQL, **divergence.SQL, **merkle.SQL}
