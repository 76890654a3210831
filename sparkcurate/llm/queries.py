"""The queries of this subpackage and the SQL that states the same results."""

from __future__ import annotations

from . import exact_dedup, forest_search, gif_media, huffman_ids, lexical_search, mixing, ngram_join, quality_crf, sentencepiece_backend, suffix_dedup, toxicity_gru, warc, whitening


def queries() -> dict:
    return {
        "op1_warc": warc.op1,
        "op2_toxicity_gru": toxicity_gru.op2,
        "op3_mixing": mixing.op3,
        "op4_gif_media": gif_media.op4,
        "op5_suffix_dedup": suffix_dedup.op5,
        "op6_quality_crf": quality_crf.op6,
        "op7_ngram_join": ngram_join.op7,
        "op8_exact_dedup": exact_dedup.op8,
        "op9_sentencepiece": sentencepiece_backend.op9,
        "op10_huffman_ids": huffman_ids.op10,
        "op11_whitening": whitening.op11,
        "op12_forest_search": forest_search.op12,
        "op13_lexical_search": lexical_search.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.OP1_SQL,
        "op3_mixing": mixing.OP3_SQL,
        "op8_exact_dedup": exact_dedup.OP8_SQL,
        "op13_lexical_search": lexical_search.OP13_SQL,
    }
