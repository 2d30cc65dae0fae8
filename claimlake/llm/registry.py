"""Queries and DuckDB oracles of the corpus operators, by name."""

from __future__ import annotations

import corpus_pipeline
from claimlake.llm import bpe, chat, decontam, langid, merkle, ngram_join, pii, sentence_pieces, suffix_dedup, topk_tree, toxicity, warc, whitening

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_topk": topk_tree.op2_topk,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_arc_to_warc": warc.op4_arc_to_warc,
    "op5_pii": pii.op5_pii,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_language_id": langid.op7_language_id,
    "op8_chat_format": chat.op8_chat_format,
    "op9_bpe": bpe.op9_bpe,
    "op10_decontaminate": decontam.op10_decontaminate,
    "op11_merkle": merkle.op11_merkle,
    "op12_sentence_pieces": sentence_pieces.op12_sentence_pieces,
    "op13_whitening": whitening.op13_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_ngram_join": ngram_join.OP1_SQL,
    "op2_topk": topk_tree.OP2_SQL,
    "op4_arc_to_warc": warc.OP4_SQL,
    "op8_chat_format": chat.OP8_SQL,
    "op11_merkle": merkle.OP11_SQL,
}
